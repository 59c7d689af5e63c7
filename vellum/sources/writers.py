"""Writers: flat tables, versioned tables, hit lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.operators.joins import first_per_key


def write_tables(tables: dict[str, DataFrame], root: str, form: str = "parquet") -> None:
    """One folder per table; ``form="csv"`` gives gzip CSV with a header for a bulk load."""
    for name, table in tables.items():
        if form == "parquet":
            table.write.mode("overwrite").parquet(f"{root}/{name}")
            continue
        arrays = {f for f, kind in table.dtypes if kind.startswith("array")}
        flat = [
            F.concat(F.lit("{"), F.array_join(f, ","), F.lit("}")).alias(f) if f in arrays else F.col(f)
            for f in table.columns
        ]
        table.select(*flat).write.mode("overwrite").csv(f"{root}/{name}", header=True, compression="gzip")


def write_version(table: DataFrame, root: str, version: int) -> str:
    """Write the next state of a table beside the old one; readers of the old version are not disturbed."""
    path = f"{root}/version={version:09d}"
    table.write.mode("overwrite").parquet(path)
    return path


def latest_version(spark: SparkSession, root: str) -> int | None:
    """Highest version whose write has finished."""
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{root}/version=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    names = [status.getPath().getParent().getName() for status in found or []]
    return max((int(name.removeprefix("version=")) for name in names), default=None)


def read_latest(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest finished version of a table, or None before the first."""
    version = latest_version(spark, root)
    return None if version is None else spark.read.parquet(f"{root}/version={version:09d}")


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    """One version of a table."""
    return spark.read.parquet(f"{root}/version={version:09d}")


def read_batch(spark: SparkSession, root: str, batch: int) -> DataFrame:
    """The rows one batch has written."""
    return spark.read.parquet(f"{root}/batch={batch}")


def append_batch(rows: DataFrame, root: str, batch: int) -> None:
    """Write one batch of a table's log. A repeated batch replaces itself, so replays are harmless."""
    rows.write.mode("overwrite").parquet(f"{root}/batch={batch}")


def read_log(
    spark: SparkSession,
    root: str,
    schema: str,
    key: str,
    before: int | None = None,
    only: DataFrame | None = None,
    order: tuple[str, ...] = (),
) -> DataFrame:
    """The state a log describes: per key the row that is last in ``order``, then by batch (below ``before``).

    Files may arrive out of order, so a table of dated records is ordered by their date. ``schema`` is that of the rows; batches not asked for are pruned as partitions. ``only`` holds the keys
    wanted: other rows are dropped before the latest ones are picked.
    """
    spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(
        spark._jvm.org.apache.hadoop.fs.Path(root)
    )
    log = spark.read.schema(f"{schema}, batch BIGINT").parquet(root)
    if before is not None:
        log = log.where(F.col("batch") < before)
    if only is not None:
        log = log.join(only.select(key), key, "left_semi")
    return first_per_key(log, [key], [*order, "batch"], last=True).drop("batch")


def hit_list(hits: DataFrame) -> DataFrame:
    """Ids of search hits with 0/1 flags, id descending."""
    return hits.select(
        F.col("id").alias("openalex_id"),
        F.coalesce("doi", F.lit("")).alias("doi"),
        F.when(F.length("abstract") > 0, 1).otherwise(0).alias("has_abstract"),
        F.when(F.col("external_abstract"), 1).otherwise(0).alias("added_abstract"),
    ).orderBy(F.desc("openalex_id"))


def write_hit_list(hits: DataFrame, path: str) -> None:
    """The hit list as CSV part files, in global order."""
    hit_list(hits).write.mode("overwrite").csv(path, header=True)
