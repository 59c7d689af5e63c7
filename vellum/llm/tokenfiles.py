"""Token files: the ids of a corpus, bit-packed, in document order.

Documents are dealt to shards by ranges of their ids and sorted within each shard; equal and missing ids are ordered by the
first characters of their texts, then by hash, so that rows without id are ranges as well. A shard is a sequence of blocks of whole documents. A block's ids are stored one after another in the fewest bits that the vocabulary
needs, least significant bit first, so that one numpy call unpacks any range of ids: id i of a block is at bit i x bits.
Blocks are rows of a Parquet table (shard, block, start, bits, doc_ids, offsets, payload): ``start`` counts the ids of the
shard before the block, ``offsets`` the ids of the block before each document and at its end. The totals of the shards,
one row each, turn starts into places in the whole corpus.

Ids are those of the library's plain call: a text with the string of an added token has that token's id. Null texts count as
empty; an empty text is only its end id. Repeated rows are stored once each. A document longer than a
block is a block of its own. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm.common import text_slices, texts
from vellum.llm.wordtable import WordTokens, byte_level
from vellum.session import scratch_path

FILE = "shard int, block int, start long, bits int, doc_ids array<{kind}>, offsets array<long>, payload binary"


@dataclass(frozen=True)
class TokenFileConfig:
    """block: ids after which a block is closed. end: the id after each document."""

    block: int = 1 << 16
    end: int = 0


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id of a vocabulary."""
    return max(1, (max(1, vocabulary) - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, least significant bit first."""
    if bits in (8, 16):
        return ids.astype("<u2" if bits == 16 else "u1", copy=False).tobytes()
    grid = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(grid.astype(np.uint8).reshape(-1), bitorder="little").tobytes()


def unpack_ids(payload: bytes, bits: int, first: int, last: int) -> np.ndarray:
    """Ids first .. last - 1 of a block, read without what stands before and after them."""
    if bits in (8, 16):
        return np.frombuffer(payload, dtype="<u2" if bits == 16 else "u1")[first:last].astype("<u4")
    lo, hi = first * bits // 8, -(-last * bits // 8)
    flat = np.unpackbits(np.frombuffer(payload, dtype=np.uint8)[lo:hi], bitorder="little")
    flat = flat[first * bits - lo * 8 :][: (last - first) * bits].reshape(-1, bits)
    return (flat.astype("<u4") << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype="<u4")


class LibrarySide:
    """A byte-level file of the tokenizers library, called as it is."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        letters, names = byte_level(), self.library.get_vocab()
        self.bytes = [b""] * (1 + max(names.values(), default=0))
        for name, i in names.items():
            self.bytes[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        #: Strings that the library takes out of a text before it looks for words.
        self.added = [token.content for token in self.library.get_added_tokens_decoder().values() if token.content]
        first = self.library.pre_tokenizer
        #: Whether texts are first cut by the usual pattern, where letters, numbers, other signs and white space part.
        self.by_kind = self.library.normalizer is None and isinstance(first, pre_tokenizers.ByteLevel) and first.use_regex and not first.add_prefix_space

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]


class TextEncoder:
    """Ids of texts as the library gives them; it is asked once for each distinct word while the word stays in a table.

    A text with the string of an added token is given to the library whole.
    """

    def __init__(self, path: str):
        self.side = LibrarySide(path)
        self.bits = bits_for(self.side.library.get_vocab_size())
        self.table = WordTokens([self.side], spaced=False, fine=self.side.by_kind)

    def encode(self, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        whole = [any(map(t.__contains__, self.side.added)) for t in docs] if self.side.added else None
        ids, counts, _ = self.table.encode(docs, whole)
        return ids[0], counts[0]


ENCODERS: dict[str, TextEncoder] = {}


def text_encoder(path: str) -> TextEncoder:
    """The encoder of a tokenizer file, built once in a Python process."""
    if path not in ENCODERS:
        ENCODERS[path] = TextEncoder(path)
    return ENCODERS[path]


def with_ends(ids: np.ndarray, counts: np.ndarray, end: int) -> np.ndarray:
    """The ids with one more after each text's."""
    out = np.full(len(ids) + len(counts), end, dtype=np.uint32)
    inside = np.ones(len(out), dtype=bool)
    inside[np.cumsum(counts + 1) - 1] = False
    out[inside] = ids
    return out


def write_token_files(
    docs: DataFrame, tokenizer: str, out: str, id_col: str = "doc_id", text_col: str = "text", config: TokenFileConfig | None = None
) -> None:
    """Encode every whole text and write the blocks below ``out``."""
    config = config or TokenFileConfig()
    kind = docs.schema[id_col].dataType.simpleString()
    keys = ["id", "begin", "digest", "row"]  # equal rows without id are told apart by where they stood
    rows = texts(docs, id_col, text_col).withColumns(
        {"begin": F.substring("text", 1, 16), "digest": F.xxhash64("text"), "row": F.monotonically_increasing_id()}
    )
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = ordered.select(F.spark_partition_id().alias("shard"), "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = text_encoder(tokenizer)
        held_ids: list = []
        held: list[np.ndarray] = []
        held_sizes: list[int] = []
        start, block, shard, id_type = 0, 0, 0, pa.int64()

        def closed() -> pa.RecordBatch:
            nonlocal start, block, held, held_ids, held_sizes
            offsets = np.concatenate([[0], np.cumsum(held_sizes)])
            row = [[shard], [block], [start], [words.bits], [held_ids], [offsets], [pack_ids(np.concatenate(held), words.bits)]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(id_type), pa.list_(pa.int64()), pa.binary()]
            start, block, held, held_ids, held_sizes = start + int(offsets[-1]), block + 1, [], [], []
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], [f.split()[0] for f in FILE.split(", ")])

        size = 0
        for batch in batches:
            if batch.num_rows:
                shard, id_type = batch.column("shard")[0].as_py(), batch.schema.field("id").type
            for ids, rows in text_slices(batch, 1 << 21):
                found, counts = words.encode(rows)
                flat, sizes = with_ends(found, counts, config.end), (counts + 1).tolist()
                first = at = begin = 0
                for last, n in enumerate(sizes, 1):
                    at += n
                    size += n
                    if size >= config.block or last == len(sizes):
                        held.append(flat[begin:at])
                        held_ids += ids[first:last]
                        held_sizes += sizes[first:last]
                        first, begin = last, at
                        if size >= config.block:
                            yield closed()
                            size = 0
        if held:
            yield closed()

    ordered.mapInArrow(run, FILE.format(kind=kind)).write.parquet(out)


def read_token_index(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of token files with their place in the corpus (``first``), and the documents' offsets."""
    blocks = spark.read.parquet(path)
    ids = F.element_at("offsets", -1)
    totals = blocks.groupBy("shard").agg(F.sum(ids).alias("total"))  # one row for each shard
    before = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    places = totals.select("shard", F.coalesce(before, F.lit(0)).alias("before"))
    # one short row for each shard, so the blocks need not move
    return blocks.join(F.broadcast(places), "shard").withColumn("first", F.col("before") + F.col("start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, computed from the unpacked ids of its block."""
    blocks = read_token_index(spark, path).select("first", "bits", "doc_ids", "offsets", "payload")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                first, bits, doc_ids, offsets, payload = (batch.column(i)[row].as_py() for i in range(5))
                crc, n = [], []
                for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
                    crc.append(zlib.crc32(unpack_ids(payload, bits, lo, hi)))
                    n.append(hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, batch.schema.field("doc_ids").type.value_type), pa.array([first + x for x in offsets[:-1]], pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return blocks.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def token_digests(docs: DataFrame, tokenizer: str, config: TokenFileConfig | None = None) -> DataFrame:
    """Write token files to the shared folder and return what reading them back gives for each document."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, tokenizer, path, config=config)
    return read_documents(docs.sparkSession, path)
