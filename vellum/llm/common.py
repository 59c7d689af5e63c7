"""Helpers shared by the text operators: tables, batches, splits and the shared scratch folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.session import scratch_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with NULL texts as empty ones; every other column stays in the scan."""
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The id of a document; without one a number above all ids that its text gives."""
    nameless = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    return F.coalesce(F.col(id_col), nameless)


def fold(id_col: str | Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo the number of folds; -1 without id."""
    return F.coalesce(F.crc32((F.col(id_col) if isinstance(id_col, str) else id_col).cast("string")) % folds, F.lit(-1))


def write_shared(df: DataFrame, name: str, file_rows: int = 0) -> DataFrame:
    """Write to the shared folder and read back: computed once, and not lost with an executor.

    ``file_rows`` is for rows of megabytes: a file holds so many at most. Parquet looks at a page's size every 100 rows, and readers
    take 4,096 rows at once if the file has them, so the memory of both would follow the size of a task's input.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(lengths: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows whose lengths add up to at most ``most`` (a longer row stands alone)."""
    start, total = 0, 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def text_slices(batch: pa.RecordBatch, most: int = 1 << 20) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of an Arrow batch in pieces of about ``most`` bytes, which bounds what the work on them takes."""
    column = batch.column("text")
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False)
    for lo, hi in slices(lengths.tolist(), most):
        yield batch.column("id").slice(lo, hi - lo).to_pylist(), column.slice(lo, hi - lo).to_pylist()


def kept_rows(docs: DataFrame, judged: Callable[[list[str]], list[bool]], text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose whole text is judged worth keeping; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text_col).fill_null("")
            lengths = pc.binary_length(column).to_pylist()
            for lo, hi in slices(lengths, 1 << 20):
                good = judged(column.slice(lo, hi - lo).to_pylist())
                yield batch.slice(lo, hi - lo).filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def byte_windows(encoded: list[bytes], width: int, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cut byte strings into windows of ``width`` bytes, zero-filled, plus ``pad`` zero bytes.

    Returns the windows, the bytes in use of each, and the number of windows of each string (one at least).
    """
    counts = np.array([max(1, -(-len(b) // width)) for b in encoded], dtype=np.int64)
    windows = np.zeros((int(counts.sum()), width + pad), dtype=np.uint8)
    used = np.zeros(len(windows), dtype=np.int64)
    row = 0
    for b, n in zip(encoded, counts.tolist(), strict=True):
        a = np.frombuffer(b, dtype=np.uint8)
        full = len(a) // width
        if full:
            windows[row : row + full, :width] = a[: full * width].reshape(full, width)
            used[row : row + full] = width
        rest = len(a) - full * width
        if rest:
            windows[row + full, :rest] = a[full * width :]
            used[row + full] = rest
        row += n
    return windows, used, counts
