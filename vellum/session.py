"""Session settings, lineage cutting and the shared scratch folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "vellum") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``.

    A local session without that setting gets a folder of its own, deleted when the session's JVM ends. On a cluster the
    setting is required, because executors do not share local folders.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^-]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = f"file:/tmp/vellum-{context.applicationId}"
    path = context._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame, name: str = "state") -> DataFrame:
    """Write to the shared folder and read back, so a lost executor does not replay the whole history.

    A written table is computed once, where an eager checkpoint computes its input twice, and its size is known
    to the joins that follow.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def widen(df: DataFrame) -> DataFrame:
    """Spread rows over ``spark.sql.shuffle.partitions`` tasks, for a source that cannot be split (one row group, gzip)."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
