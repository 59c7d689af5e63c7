"""Incremental jobs, replayed to their end; each must give what the batch job gives."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions.ids import strip_id
from vellum.operators.joins import spread_nulls
from vellum.plans import fixtures as fx
from vellum.plans.registry import ORACLES, job
from vellum.plans.scans import publish
from vellum.plans.tables import now
from vellum.session import scratch_path
from vellum.sources.keyed import KeyedLog
from vellum.sources.writers import read_log
from vellum.streaming import incremental

#: Changes that are published together are cut into so many of them for every file of a day.
DAY_ROWS = 1 << 20


@job(
    "str_snapshot_incremental",
    """
    WITH <<works>>
    SELECT concat('W', doc_id) AS id, title, abstract, CAST(updated_date AS STRING) AS updated_date FROM works
    """,
)
def str_snapshot_incremental(spark, sf_dir):
    root = scratch_path(spark, "ingest")
    # older states of the works come in files of their own, after the newer ones
    publish(fx.works(spark, sf_dir), root)
    stale = fx.works(spark, sf_dir).where("lang <> 'fr'").withColumns(
        {"updated_date": F.date_sub("updated_date", 7), "title": F.lit("stale"), "abstract": F.lit("stale")}
    )
    publish(stale, root)
    records = incremental.stream_snapshot(
        spark, root, "work", "id STRING, title STRING, abstract STRING", maxFilesPerTrigger="60"
    )

    def shape(rows):
        return rows.select(
            strip_id(F.col("id")).alias("id"), "title", "abstract",
            F.col("updated_date").cast("string").alias("updated_date"),
        )

    incremental.start_ingest(records, "id", f"{root}/log", f"{root}/checkpoint", shape).awaitTermination()
    schema = "id STRING, title STRING, abstract STRING, updated_date STRING"
    return KeyedLog(spark, f"{root}/log", "id", schema, ("updated_date",)).read()


def publish_days(rows: DataFrame, path: str) -> None:
    """Add changes as one folder per day. A batch of a stream takes files, so their number follows the rows, not the tasks that made them."""
    files = -(-rows.count() // DAY_ROWS)
    part = F.pmod(F.xxhash64(spread_nulls(F.col("id"), ["doi", "title"])), F.lit(max(files, 1)))
    dealt = rows.withColumn("day", F.col("updated_date")).repartition("day", part)
    dealt.write.mode("append").partitionBy("day").parquet(path)


@job(
    "str_daily_update",
    ORACLES["upd_preserve_abstract"].replace("SELECT id, title,", "SELECT 'index' AS part, id, title,")
    + """
    UNION ALL
    SELECT 'queue', id, doi, NULL, NULL, '2024-06-01 12:00:00' FROM upd WHERE abstract IS NULL AND doi IS NOT NULL
    """,
)
def str_daily_update(spark, sf_dir):
    root = scratch_path(spark, "daily")
    index = fx.index(spark, sf_dir)
    update = fx.update(spark, sf_dir)
    # the index as it was, and the changes as one folder per day
    documents = incremental.index_log(spark, f"{root}/index", update.schema)
    documents.append(index, -1, index.count())
    stale = update.where("is_xpac").withColumns(
        {"updated_date": F.date_sub("updated_date", 20), "title": F.lit("stale"), "abstract": F.lit(None).cast("string")}
    )
    for rows in (update, stale):  # older states of some works arrive last
        publish_days(rows, f"{root}/changes")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in update.schema.fields)
    changes = (
        spark.readStream.schema(f"{schema}, day DATE").option("maxFilesPerTrigger", "2").parquet(f"{root}/changes")
    ).drop("day")
    incremental.start_daily_update(
        changes, f"{root}/index", f"{root}/queue", f"{root}/checkpoint", now()
    ).awaitTermination()
    rows = documents.read()
    queued = incremental.queue_log(spark, f"{root}/queue").read()
    stamp = "yyyy-MM-dd HH:mm:ss"
    return rows.select(
        F.lit("index").alias("part"), "id", "title", "abstract", "abstract_source",
        F.date_format("abstract_date", stamp).alias("abstract_date"),
    ).unionByName(
        queued.select(
            F.lit("queue").alias("part"), F.col("openalex_id").alias("id"), F.col("doi").alias("title"),
            F.lit(None).cast("string").alias("abstract"), F.lit(None).cast("string").alias("abstract_source"),
            F.date_format("time_created", stamp).alias("abstract_date"),
        )
    )


@job(
    "str_daily_stats",
    """
    SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n_total,
           count(*) FILTER (WHERE value > 10) AS n_with_title, count(*) FILTER (WHERE value > 20) AS n_with_abstract,
           count(*) FILTER (WHERE event_type = 'click') AS n_with_scopus,
           count(*) FILTER (WHERE event_type = 'view') AS n_with_dimensions
    FROM events GROUP BY 1
    """,
)
def str_daily_stats(spark, sf_dir):
    root = scratch_path(spark, "stats")
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parq*")
    requests = events.select(
        # event time must be an instant: the wall clock of the events is taken as UTC
        F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()).alias("time_created"),
        F.when(F.col("value") > 10, F.lit("t")).alias("title"),
        F.when(F.col("value") > 20, F.lit("a")).alias("abstract"),
        F.col("props").alias("raw"),
        F.when(F.col("event_type") == "click", "SCOPUS")
        .when(F.col("event_type") == "view", "DIMENSIONS")
        .otherwise("WOS")
        .alias("wrapper"),
    )
    incremental.start_daily_stats(requests, f"{root}/log", f"{root}/checkpoint").awaitTermination()
    return read_log(
        spark,
        f"{root}/log",
        "day STRING, n_total BIGINT, n_with_title BIGINT, n_with_abstract BIGINT, n_with_scopus BIGINT, "
        "n_with_dimensions BIGINT",
        "day",
    )
