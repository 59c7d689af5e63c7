"""Alignment of two tokenizers' tokens over the same bytes.

A text is read as one space and the text: tokenizer A encodes it so, tokenizer B adds the space itself. In each batch of
documents ``pandas.merge_asof``, keyed by document, finds for every token start the token of the other side that covers it.
Both directions together are all overlapping pairs of tokens (a pair that starts at one place is found twice and kept once).
Places where tokens of both sides end cut a text into groups.

A pair of ids counts as many documents as hold it linked. Each batch sends its distinct pairs with their numbers of documents;
the shuffle adds them up, and each batch gets back the counts of its own pairs, so a pair that every document holds
costs one row a batch.

A text that is null or empty, or whose tokens' joined bytes on either side are not the space and the text, has no tokens.
Strings of special tokens in a text are plain text. Repeated rows count each time; rows without id keep a null id. A
very long text is a batch of its own. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import slices, texts, write_shared
from vellum.llm.wordtable import WordTokens, byte_level

@dataclass(frozen=True)
class AlignmentConfig:
    """batch: bytes of text whose pairs are sent together. part: bytes of it aligned at once. kept: words in the table of a Python process, twice at most."""

    batch: int = 1 << 20
    part: int = 1 << 18
    kept: int = 150_000


class ByteLevelSide:
    """A tokenizers file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        letters = byte_level()
        names = self.library.get_vocab()
        self.bytes = [b""] * (1 + max(names.values(), default=0))
        for name, i in names.items():
            self.bytes[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]


class PieceSide:
    """A sentencepiece file, which adds the space that its texts begin with."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode())
        self.space = self.library.piece_to_id("▁")

    def encode(self, texts: list[str]) -> list[list[int]]:
        found = self.library.encode([t[1:] for t in texts], num_threads=1)
        return [x if len(t) > 1 else [self.space] for t, x in zip(texts, found, strict=True)]


SIDES: dict[tuple[str, str], WordTokens] = {}


def both_sides(a: str, b: str, kept: int = AlignmentConfig.kept) -> WordTokens:
    """The two tokenizers, loaded once in a Python process."""
    if (a, b) not in SIDES:
        SIDES[a, b] = WordTokens((ByteLevelSide(a), PieceSide(b)))
    SIDES[a, b].kept = kept
    return SIDES[a, b]


@dataclass
class Alignment:
    """Tokens of a batch on both sides with their texts and byte ranges, the links as rows of both, and which tokens end where
    one of the other side ends."""

    a: pd.DataFrame
    b: pd.DataFrame
    link_a: np.ndarray
    link_b: np.ndarray
    closes_a: np.ndarray
    closes_b: np.ndarray

    def of_text(self, rows: np.ndarray, n: int) -> np.ndarray:
        """How many of the rows belong to each of n texts."""
        return np.bincount(rows, minlength=n)


def tokens(ids: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> pd.DataFrame:
    """(doc, start, end, id, row) of tokens that stand one after another; all places count from the batch's first byte."""
    length = sizes[ids]
    end = np.cumsum(length)
    doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    return pd.DataFrame({"doc": doc, "start": end - length, "end": end, "id": ids, "row": np.arange(len(ids), dtype=np.int32)}, copy=False)


def align(a: pd.DataFrame, b: pd.DataFrame) -> Alignment:
    """Link all overlapping tokens of the two sides and find their common ends."""
    left, right = a[["doc", "start"]], b[["doc", "start"]]
    over = pd.merge_asof(left, b[["doc", "start", "row"]], on="start", by="doc")["row"].to_numpy(dtype=np.int64)
    back = pd.merge_asof(right, a[["doc", "start", "row"]], on="start", by="doc")["row"].to_numpy(dtype=np.int64)
    # pairs that start at one place are in the first direction
    more = np.flatnonzero(a["start"].to_numpy()[back] != b["start"].to_numpy())
    link_a = np.concatenate([np.arange(len(a)), back[more]])
    link_b = np.concatenate([over, more])
    # a token that ends where the last token that covers it on the other side ends closes a group
    end_a, end_b = a["end"].to_numpy(), b["end"].to_numpy()
    closes_a, closes_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
    both = end_a[link_a] == end_b[link_b]
    closes_a[link_a[both]], closes_b[link_b[both]] = True, True
    return Alignment(a, b, link_a, link_b, closes_a, closes_b)


def decimals(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of ids, right-aligned in rows, and how many each has."""
    width = len(str(int(ids.max(initial=0))))
    every = np.arange(10**width) if 10**width < len(ids) else ids  # a table of all numbers, if that is less work
    rows = (every[:, None] // 10 ** np.arange(width - 1, -1, -1) % 10 + 48).astype(np.uint8)
    shown = np.searchsorted(10 ** np.arange(1, width), every, side="right") + 1
    return (rows, shown) if every is ids else (rows[ids], shown[ids])


def group_texts(found: Alignment, texts: int) -> list[bytes]:
    """For each text the groups as ``a1,a2|b1;a3|b2``."""
    closes = found.closes_a, found.closes_b
    group = [np.cumsum(c) - c for c in closes]
    last = [np.flatnonzero(c) for c in closes]  # of each group
    ends = [x + 1 for x in last]
    # the tokens of A of a group stand before those of B
    place_a = np.arange(len(group[0])) + np.concatenate([[0], ends[1]])[group[0]]
    place_b = np.arange(len(group[1])) + ends[0][group[1]]
    total = len(place_a) + len(place_b)
    ids, sign = np.empty(total, np.int32), np.full(total, ord(","), np.uint8)
    ids[place_a], ids[place_b] = found.a["id"].to_numpy(), found.b["id"].to_numpy()
    sign[place_a[last[0]]], sign[place_b[last[1]]] = ord("|"), ord(";")
    rows, shown = decimals(ids)
    width = rows.shape[1]
    shapes = np.ones((width + 1, width + 1), dtype=bool)  # by number of digits, the places in use
    shapes[:, :width] = np.arange(width) >= (width - np.arange(width + 1))[:, None]
    wide = np.empty((total, width + 1), dtype=np.uint8)
    wide[:, :width], wide[:, width] = rows, sign
    flat = wide[shapes[shown]].tobytes()
    held = found.of_text(found.a["doc"].to_numpy(), texts) + found.of_text(found.b["doc"].to_numpy(), texts)
    sizes = np.concatenate([[0], np.cumsum(shown + 1)])
    borders = sizes[np.concatenate([[0], np.cumsum(held)])].tolist()
    return [flat[lo : max(lo, hi - 1)] for lo, hi in zip(borders[:-1], borders[1:], strict=True)]


def batched(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) of about ``most`` bytes, across Arrow batches."""
    ids: list[pa.Array] = []
    held: list[str] = []
    size = 0
    for batch in batches:
        column = batch.column("text")
        lengths = pc.binary_length(column).to_pylist()
        for lo, hi in slices(lengths, most):
            part = sum(lengths[lo:hi])
            if held and size + part > most:
                yield pa.concat_arrays(ids), held
                ids, held, size = [], [], 0
            ids.append(batch.column("id").slice(lo, hi - lo))
            held += column.slice(lo, hi - lo).to_pylist()
            size += part
    if held:
        yield pa.concat_arrays(ids), held


def aligned_batch(sides: WordTokens, docs: list[str]) -> Alignment:
    ids, counts, right = sides.encode(docs)
    if not right.all():
        ids = [x[np.repeat(right, n)] for x, n in zip(ids, counts, strict=True)]
        counts = [np.where(right, n, 0) for n in counts]
    (ids_a, ids_b), (n_a, n_b) = ids, counts
    return align(tokens(ids_a, n_a, sides.sizes[0]), tokens(ids_b, n_b, sides.sizes[1]))


def batch_part(sides: WordTokens, docs: list[str], first: int) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """Tokens of A and of B, groups and links of each text; the groups' digests; the text, counted from ``first``, and the pair of each link."""
    found, n = aligned_batch(sides, docs), len(docs)
    doc_a, doc_b = found.a["doc"].to_numpy(), found.b["doc"].to_numpy()
    links_of = doc_a[found.link_a]
    numbers = np.stack([found.of_text(x, n) for x in (doc_a, doc_b, doc_a[found.closes_a], links_of)])
    digests = [hashlib.sha256(t).hexdigest() if t else "" for t in group_texts(found, n)]
    code = (found.a["id"].to_numpy().astype(np.int64)[found.link_a] << 32) | found.b["id"].to_numpy()[found.link_b]
    return numbers, digests, links_of.astype(np.int64) + first, code


def token_links(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text", config: AlignmentConfig | None = None) -> DataFrame:
    """(doc_id, a_ids, a_ends, b_ids, b_ends, links, group_ends) of every document.

    Ends are byte offsets in the space and the text; a link is the place of a token of A and of one of B, counted from 0.
    """
    config = config or AlignmentConfig()
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = both_sides(a, b, config.kept)
        for ids, held in batched(batches, config.batch):
            found = aligned_batch(sides, held)
            out = []
            docs_a, docs_b = found.a["doc"].to_numpy(), found.b["doc"].to_numpy()
            cut = [np.searchsorted(d, np.arange(len(held) + 1)) for d in (docs_a, docs_b)]
            order = np.lexsort((found.link_b, found.link_a))
            link_a, link_b = found.link_a[order], found.link_b[order]
            for i, doc_id in enumerate(ids.to_pylist()):
                (lo, hi), (p, q) = cut[0][i : i + 2], cut[1][i : i + 2]
                base = int(found.a["start"].iat[lo]) if hi > lo else 0
                end_a, end_b = found.a["end"].to_numpy()[lo:hi] - base, found.b["end"].to_numpy()[p:q] - base
                first, last = np.searchsorted(link_a, [lo, hi])
                links = np.stack([link_a[first:last] - lo, link_b[first:last] - p], axis=1)
                out.append((doc_id, found.a["id"].to_numpy()[lo:hi].tolist(), end_a.tolist(), found.b["id"].to_numpy()[p:q].tolist(), end_b.tolist(), links.tolist(), np.intersect1d(end_a, end_b).tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), [ids.type, *[pa.list_(pa.int32())] * 4, pa.list_(pa.list_(pa.int32())), pa.list_(pa.int32())], strict=True)],
                ["doc_id", "a_ids", "a_ends", "b_ids", "b_ends", "links", "group_ends"],
            )

    arrays = ", ".join(f"{c} array<int>" for c in ("a_ids", "a_ends", "b_ids", "b_ends"))
    return rows.mapInArrow(run, f"doc_id {kind}, {arrays}, links array<array<int>>, group_ends array<int>")


NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def batch_links(batches: Iterator[pa.RecordBatch], a: str, b: str, config: AlignmentConfig, number: int) -> Iterator[pa.RecordBatch]:
    """A row for each batch of texts: its numbers and digests, its distinct pairs, and which of them each text holds how often."""
    sides = both_sides(a, b, config.kept)
    for ids, held in batched(batches, config.batch):
        n = len(held)
        parts = [batch_part(sides, held[lo:hi], lo) for lo, hi in slices([len(t) for t in held], config.part)]
        numbers, digests, links_of, code = zip(*parts, strict=True)
        del parts
        numbers, digests = np.concatenate(numbers, axis=1), [t for part in digests for t in part]
        links_of, code = np.concatenate(links_of), np.concatenate(code)
        pairs, at = np.unique(code, return_inverse=True)
        cells, times = np.unique(links_of * max(1, len(pairs)) + at, return_counts=True)
        cell_doc, cell_pair = cells // max(1, len(pairs)), cells % max(1, len(pairs))
        docs_of = np.bincount(cell_pair, minlength=len(pairs))
        blobs = [np.searchsorted(cell_doc, np.arange(n + 1)), cell_pair, times]
        columns = [pa.array([number], pa.int64()), pa.array([ids.to_pylist()], pa.list_(ids.type))]
        columns += [pa.array([x], pa.list_(pa.int64())) for x in numbers]
        columns += [pa.array([digests], pa.list_(pa.string())), pa.array([pairs], pa.list_(pa.int64())), pa.array([docs_of], pa.list_(pa.int64()))]
        columns += [pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in blobs]
        yield pa.RecordBatch.from_arrays(columns, ["batch", "doc_ids", *NUMBERS, "digests", "pairs", "docs_of", "borders", "cells", "times"])
        number += 1


def alignment_digests(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text", config: AlignmentConfig | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    n_best are the links whose pair has the highest count of all pairs of its id of A, count_sum adds up the links' counts.
    """
    config = config or AlignmentConfig()
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    names = NUMBERS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batch_links(batches, a, b, config, TaskContext.get().partitionId() << 32)

    longs = ", ".join(f"{c} array<long>" for c in names)
    stored = write_shared(
        rows.mapInArrow(run, f"batch long, doc_ids array<{kind}>, {longs}, digests array<string>, pairs array<long>, docs_of array<long>, borders binary, cells binary, times binary"),
        "alignment",
    )
    held = stored.select("batch", F.explode(F.arrays_zip("pairs", "docs_of")).alias("x")).select("batch", "x.*")
    counts = held.groupBy("pairs").agg(F.sum("docs_of").alias("count")).withColumn("a", F.shiftright("pairs", 32))
    best = counts.groupBy("a").agg(F.max("count").alias("most"))
    judged = counts.join(best, "a").select("pairs", "count", (F.col("count") == F.col("most")).alias("best"))
    answers = held.select("batch", "pairs").join(judged, "pairs")
    answers = answers.groupBy("batch").agg(F.collect_list(F.struct("pairs", "count", "best")).alias("answers"))
    back = stored.drop("pairs", "docs_of").join(answers, "batch", "left")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = {c: batch.column(c)[i] for c in batch.schema.names}
                borders, cells, times = (np.frombuffer(one[c].as_py(), dtype=np.int32) for c in ("borders", "cells", "times"))
                got = one["answers"].values
                sums = np.zeros((2, len(cells) + 1), dtype=np.int64)
                if got is not None and len(got):
                    order = np.argsort(got.field("pairs").to_numpy())
                    for row, name in enumerate(("count", "best")):
                        value = got.field(name).to_numpy(zero_copy_only=False).astype(np.int64)[order]
                        sums[row, 1:] = np.cumsum(value[cells] * times)
                count_sum, n_best = np.diff(sums[:, borders], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [one["doc_ids"].values, *[one[c].values for c in names], pa.array(n_best), pa.array(count_sum), one["digests"].values],
                    ["doc_id", *names, "n_best", "count_sum", "groups_sha256"],
                )

    out = ", ".join(f"{c} long" for c in [*names, "n_best", "count_sum"])
    return back.mapInArrow(finish, f"doc_id {kind}, {out}, groups_sha256 string")
