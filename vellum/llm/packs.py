"""Packs: neighbouring rows of a table as one row, so that numpy sees many texts at once and answers find their way back.

A pack holds whole texts of up to ``most`` bytes together (a longer text is a pack of its own) and has a number that no
other pack has. Packs are written once to the shared folder, so a task that runs again sees the same packs.

Fixed-width values that packs send out are dealt to buckets by the upper bits of 64-bit hashes. What a pack sends to a
bucket is one row, sorted by hash, and the bucket's answer is one bit for each value in the same order, so a value that
every text holds arrives once from each pack and nothing but bits goes back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import slices, write_shared

U = np.uint64


@dataclass
class Pack:
    """The texts of a pack as UTF-8: text i is ``data[starts[i] : starts[i] + sizes[i]]``; ``keys`` has a value for each text."""

    number: int
    keys: list
    sizes: np.ndarray
    starts: np.ndarray
    data: np.ndarray


def make_packs(docs: DataFrame, key: Column, most: int, text_col: str = "text") -> DataFrame:
    """Write (pack, keys, sizes, data) rows; NULL texts count as empty ones."""
    rows = docs.select(key.alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        squeeze = zstandard.ZstdCompressor(level=1)
        held: list[pa.RecordBatch] = []
        size = 0

        def closed() -> pa.RecordBatch:
            nonlocal number, held, size
            table = pa.Table.from_batches(held).combine_chunks()
            text = table.column("text").cast(pa.large_binary()).combine_chunks()
            sizes = pc.binary_length(text).cast(pa.int64()).to_pylist()
            data = squeeze.compress(b"".join(text.to_pylist()))
            keys = table.column("key").to_pylist()
            fields = [pa.array([number], pa.int64()), pa.array([keys], pa.list_(table.schema.field("key").type))]
            fields += [pa.array([sizes], pa.list_(pa.int64())), pa.array([data], pa.binary())]
            number, held, size = number + 1, [], 0
            return pa.RecordBatch.from_arrays(fields, ["pack", "keys", "sizes", "data"])

        for batch in batches:
            lengths = pc.binary_length(batch.column("text")).to_pylist()
            for lo, hi in slices(lengths, most):
                part = sum(lengths[lo:hi])
                if held and size + part > most:
                    yield closed()
                held.append(batch.slice(lo, hi - lo))
                size += part
        if held:
            yield closed()

    return write_shared(rows.mapInArrow(run, f"pack long, keys array<{kind}>, sizes array<long>, data binary"), "packs")


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Pack, dict]]:
    """The packs of Arrow batches, with what else their rows hold."""
    for batch in batches:
        rest = [c for c in batch.schema.names if c not in ("pack", "keys", "sizes", "data")]
        for i in range(batch.num_rows):
            number, keys, data = (batch.column(c)[i].as_py() for c in ("pack", "keys", "data"))
            sizes = np.array(batch.column("sizes")[i].as_py(), dtype=np.int64)
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
            pack = Pack(number, keys, sizes, np.cumsum(sizes) - sizes, raw)
            yield pack, {c: batch.column(c)[i].as_py() for c in rest}


def total_bytes(packs: DataFrame) -> int:
    """Bytes of all texts."""
    return packs.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda x, y: x + y))).first()[0] or 0


def cuts(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of sorted hashes, by their upper half, and where the values of each begin, with the end."""
    bucket = (((hashes >> U(32)) * U(buckets)) >> U(32)).astype(np.int32)
    new = np.ones(len(bucket), dtype=bool)
    new[1:] = bucket[1:] != bucket[:-1]
    first = np.flatnonzero(new)
    return bucket[first], np.append(first, len(bucket))


def sent(pack: int, hashes: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    """(bucket, pack, prints, counts): the sorted hashes of a pack by bucket; a print is the lower half of a hash."""
    full, at = cuts(hashes, buckets)
    prints, counts = hashes.astype(np.uint32), np.minimum(counts, 255).astype(np.uint8)
    ranges = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(full),
            pa.array(np.full(len(full), pack, dtype=np.int64)),
            pa.array([prints[lo:hi].tobytes() for lo, hi in ranges], pa.binary()),
            pa.array([counts[lo:hi].tobytes() for lo, hi in ranges], pa.binary()),
        ],
        ["bucket", "pack", "prints", "counts"],
    )


SENT = "bucket int, pack long, prints binary, counts binary"


def summed(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Of what a bucket got: sum of the counts and number of packs for each sent print, the print, and the rows' borders."""
    parts = [np.frombuffer(b, dtype=np.uint32) for b in group.column("prints").to_pylist()]
    prints = np.concatenate(parts)
    counts = np.frombuffer(b"".join(group.column("counts").to_pylist()), dtype=np.uint8).astype(np.int64)
    order = np.argsort(prints)
    new = np.ones(len(prints), dtype=bool)
    ordered = prints[order]
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(prints)))
    total, packs = np.empty(len(prints), np.int64), np.empty(len(prints), np.int64)
    total[order] = np.repeat(np.add.reduceat(counts[order], first), sizes)
    packs[order] = np.repeat(sizes, sizes)
    return total, packs, prints, [0, *np.cumsum([len(p) for p in parts]).tolist()]


def marked(keys: DataFrame, wanted: Callable[[np.ndarray, np.ndarray], list[np.ndarray]]) -> DataFrame:
    """(pack, answers): for each pack, its own values in order, one bit for each question about its sum and number of packs."""

    def answer(group: pa.Table) -> pa.Table:
        total, packs, _, at = summed(group)
        bits = wanted(total, packs)
        answers = [b"".join([np.packbits(b[lo:hi]).tobytes() for b in bits]) for lo, hi in zip(at[:-1], at[1:], strict=True)]
        return pa.table({"pack": group.column("pack"), "bucket": group.column("bucket"), "bits": pa.array(answers, pa.binary())})

    answers = keys.groupBy("bucket").applyInArrow(answer, "pack long, bucket int, bits binary")
    return answers.groupBy("pack").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))


def received(answers: list | None, hashes: np.ndarray, buckets: int, questions: int = 1) -> np.ndarray:
    """The bits of a pack's sorted values, a row for each question, from the answers of all buckets."""
    full, at = cuts(hashes, buckets)
    place = dict(zip(full.tolist(), zip(at[:-1].tolist(), at[1:].tolist(), strict=True), strict=True))
    out = np.zeros((questions, len(hashes)), dtype=bool)
    for a in answers or []:
        lo, hi = place[a["bucket"]]
        bits = np.unpackbits(np.frombuffer(a["bits"], dtype=np.uint8).reshape(questions, -1), axis=1)
        out[:, lo:hi] = bits[:, : hi - lo]
    return out


#: The polynomial's base and its inverse modulo 2 ** 64.
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(int(BASE), -1, 1 << 64))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, dtype=U)
    out[:1] = 1
    return np.cumprod(out, dtype=U)


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Prefix polynomials: entry i is the sum of the first i values times the powers of the base."""
    return np.concatenate([np.zeros(1, U), np.cumsum(values.astype(U) * powers(BASE, len(values)), dtype=U)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))
