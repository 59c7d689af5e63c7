"""Incremental jobs as Structured Streaming queries.

Every batch adds its rows to a table's log and nothing else; a repeated batch changes nothing. The state of a table is the
row per key with the latest date, of equal dates the one that came last, since files need not arrive in the order of their
records. A batch only sees what earlier batches have written, and opens the buckets of its own keys only; the log merges what
batches have left (``vellum.sources.keyed``).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from vellum.operators.joins import first_per_key
from vellum.operators.reports import stats_columns
from vellum.operators.upsert import updated_documents
from vellum.sources.keyed import KeyedLog
from vellum.sources.snapshot import CORRUPT
from vellum.sources.writers import append_batch


def stream_snapshot(spark: SparkSession, root: str, entity: str, schema: str, **options: str) -> DataFrame:
    """New files of a snapshot, each read once; what was read is remembered by the query's checkpoint."""
    fields = re.sub(r",\s*updated_date STRING", "", f"{schema}, {CORRUPT} STRING")
    reader = spark.readStream.schema(f"{fields}, updated_date DATE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.options(**options).json(f"{root}/{entity}s")


def start_ingest(
    records: DataFrame, key: str, out: str, checkpoint: str, shape: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Bring records into a table's log, one row per key and batch: the one updated last."""

    def write(batch: DataFrame, number: int) -> None:
        good = batch.where(F.col(CORRUPT).isNull() & F.col(key).isNotNull()).drop(CORRUPT)
        order = F.struct("updated_date", F.xxhash64(*[c for c in good.columns if c != key]))
        rows = first_per_key(good, [key], [order], last=True)
        rows = shape(rows) if shape else rows
        KeyedLog(batch.sparkSession, out, key, rows.schema, ("updated_date",)).append(rows, number)

    return (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def index_log(spark: SparkSession, root: str, updates: StructType, **options: int) -> KeyedLog:
    """The log of an index that updates of a schema go into."""
    more = StructType.fromDDL("title_abstract STRING, abstract_date TIMESTAMP_NTZ").fields
    return KeyedLog(spark, root, "id", StructType([*updates.fields, *more]), ("updated_date",), **options)


def queue_log(spark: SparkSession, root: str, **options: int) -> KeyedLog:
    """The log of works to queue: a work that is reported again stays one entry."""
    return KeyedLog(spark, root, "openalex_id", "openalex_id STRING, doi STRING, time_created TIMESTAMP_NTZ", **options)


def start_daily_update(updates: DataFrame, index: str, queue: str, checkpoint: str, now: Column) -> StreamingQuery:
    """Daily changes: put updated works into the index without losing abstracts, queue those that lack one.

    The log at ``index`` (``index_log``) holds the index, its first batch below 0. Only documents of updated ids are looked at
    and written. An update older than its document is left out. Every work that an update shows without abstract is
    queued once, also where the old abstract was kept or the work is known: picking entries tells those apart.
    """
    schema = updates.schema

    def write(batch: DataFrame, number: int) -> None:
        order = F.struct("updated_date", F.xxhash64(*[c for c in batch.columns if c != "id"]))
        given = first_per_key(batch.where(F.col("id").isNotNull()), ["id"], [order], last=True).persist()
        latest = given
        documents = index_log(batch.sparkSession, index, schema)
        before = documents.read(only=latest, before=number)
        # read once, of the columns that are compared or kept
        before = before.select("id", "updated_date", "abstract", "abstract_source", "abstract_date").persist()
        newer = before.select("id", F.col("updated_date").alias("_known"))
        latest = latest.join(newer, "id", "left").where(F.coalesce(F.col("updated_date") >= F.col("_known"), F.lit(True)))
        latest = latest.drop("_known")
        documents.append(updated_documents(before, latest, now, found=True), number)
        lacking = latest.where(F.col("abstract").isNull() & F.col("doi").isNotNull())
        entries = lacking.select(F.col("id").alias("openalex_id"), "doi", now.alias("time_created"))
        queue_log(batch.sparkSession, queue).append(entries, number)
        before.unpersist()
        given.unpersist()

    return (
        updates.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_daily_stats(requests: DataFrame, out: str, checkpoint: str, lateness: str = "2 days") -> StreamingQuery:
    """Counters per UTC day kept while cache rows arrive; a day's state is dropped once rows for it are too late."""
    start = F.to_utc_timestamp("w.start", F.current_timezone())
    counted = (
        requests.withWatermark("time_created", lateness)
        .groupBy(F.window("time_created", "1 day").alias("w"))
        .agg(*stats_columns())
        .select(
            F.date_format(start, "yyyy-MM-dd").alias("day"), "n_total", "n_with_title", "n_with_abstract",
            "n_with_scopus", "n_with_dimensions",
        )
    )

    def write(batch: DataFrame, number: int) -> None:
        append_batch(batch, out, number)

    return (
        counted.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
