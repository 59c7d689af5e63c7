"""Best-fit packing of documents into training sequences, with conflicts.

Documents are placed longest first into the bin with the least sufficient room that conflicts with none of them: a bin
takes one document of each source and one of each duplicate cluster, which its two bitmaps record. The open bins are
ordered by residual; the search starts at the length and goes to the next larger residual until a bin is compatible, so
the bin found is the tightest compatible one. A new bin is opened if there is none.

Documents are dealt by a hash of their id, length, source and cluster to shards of about ``shard`` pieces, each packed on its
own, so neither a hot source nor a hot cluster meets in one task; rows without id are dealt by where they stand in the stored
pieces, however many there are. The bin found is the tightest compatible one of its shard.

A document longer than a bin is cut into pieces of the bin's capacity and a rest; no piece is dropped. A length that is
null or below one counts as one; a null source or cluster conflicts with nothing. Repeated rows are placed once each.
Ties go by length, id (missing ones first), piece. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import slices, write_shared


@dataclass(frozen=True)
class PackingConfig:
    """capacity: length of a bin. shard: pieces packed together, on average."""

    capacity: int = 2048
    shard: int = 4096


def bits(values: list) -> list[int]:
    """One bit for each value that occurs twice or more, none for null and for values that cannot conflict."""
    seen: dict = {}
    for v in values:
        seen[v] = seen.get(v, 0) + 1
    place = {v: i for i, v in enumerate(v for v, n in seen.items() if n > 1 and v is not None)}
    return [1 << place[v] if v in place else 0 for v in values]


def best_fit(lengths: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset in the bin) of each piece; the pieces come in the order of placement, the conflicts as bits."""
    open_bins: list[tuple[int, int]] = []  # (residual, bin), ascending
    held_sources: list[int] = []
    held_clusters: list[int] = []
    placed = []
    for length, source, cluster in zip(lengths, sources, clusters, strict=True):
        at = bisect_left(open_bins, (length, -1))
        while at < len(open_bins):
            b = open_bins[at][1]
            if not (held_sources[b] & source or held_clusters[b] & cluster):
                break
            at += 1
        if at < len(open_bins):
            residual, b = open_bins.pop(at)
        else:
            residual, b = capacity, len(held_sources)
            held_sources.append(0)
            held_clusters.append(0)
        held_sources[b] |= source
        held_clusters[b] |= cluster
        placed.append((b, capacity - residual))
        if residual > length:
            insort(open_bins, (residual - length, b))
    return placed


def pack(
    docs: DataFrame, length: Column, source: Column, cluster: Column, id_col: str = "doc_id", config: PackingConfig | None = None
) -> DataFrame:
    """(doc_id, piece, start, length, bin_id, bin_offset): where each piece of each document goes."""
    config = config or PackingConfig()
    capacity = config.capacity
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.greatest(F.coalesce(length, F.lit(1)), F.lit(1)).cast("long").alias("total"),
        source.cast("string").alias("source"), cluster.cast("string").alias("cluster"),
    )
    last = F.floor((F.col("total") - 1) / capacity).cast("long")
    cut = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last))).withColumn("row", F.monotonically_increasing_id())
    pieces = write_shared(cut, "pieces")
    shards = max(1, -(-pieces.count() // config.shard))
    dealt = pieces.select(
        "doc_id", "piece", (F.col("piece") * capacity).alias("start"),
        F.least(F.lit(capacity), F.col("total") - F.col("piece") * capacity).alias("length"), "source", "cluster",
        F.pmod(F.xxhash64("doc_id", "piece", F.when(F.col("doc_id").isNull(), F.col("row")).otherwise(F.xxhash64("total", "source", "cluster"))), F.lit(shards)).alias("shard"),
    )

    def place(group: pa.Table) -> pa.Table:
        ids, pieces, lengths, shards = (group.column(c).to_pylist() for c in ("doc_id", "piece", "length", "shard"))
        order = sorted(range(len(ids)), key=lambda i: (-lengths[i], ids[i] is not None, ids[i] if ids[i] is not None else 0, pieces[i]))
        sources, clusters = (bits([group.column(c)[i].as_py() for i in order]) for c in ("source", "cluster"))
        placed = best_fit([lengths[i] for i in order], sources, clusters, capacity)
        out = group.select(["doc_id", "piece", "start", "length"]).take(pa.array(order))
        out = out.append_column("bin_id", pa.array([(shards[0] << 24) + b for b, _ in placed], pa.int64()))
        return out.append_column("bin_offset", pa.array([x for _, x in placed], pa.int64()))

    kind = docs.schema[id_col].dataType.simpleString()
    return dealt.groupBy("shard").applyInArrow(
        place, f"doc_id {kind}, piece long, start long, length long, bin_id long, bin_offset long"
    )


def word_length(text_col: str = "text") -> Column:
    """Words between white space, and one end."""
    return F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"\S+")) + 1


#: White space of ``word_length``.
SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\f\r", dtype=np.uint8))


def count_words(texts: pa.Array) -> np.ndarray:
    """Words between white space of each text, read from the bytes of the column."""
    column = texts.fill_null("").cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    out = np.zeros(len(column), dtype=np.int64)
    for lo, hi in slices(np.diff(at).tolist(), 1 << 20):
        begin, ends = at[lo], at[lo + 1 : hi + 1] - at[lo]
        if ends[-1]:
            inside = ~SPACE[np.frombuffer(column.buffers()[2], dtype=np.uint8)[begin : at[hi]]]
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            borders = ends[:-1][ends[:-1] < ends[-1]]
            first[borders] = inside[borders]  # a text begins anew
            out[lo:hi] = np.diff(np.searchsorted(np.flatnonzero(first), ends), prepend=0)
    return out


def word_lengths(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with ``word_length`` (words) in place of their text."""
    kept = [f for f in docs.schema.fields if f.name != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.select([f.name for f in kept])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(count_words(batch.column(text_col)) + 1)], [*rest.schema.names, "words"])

    return docs.mapInArrow(run, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], "words long"]))
