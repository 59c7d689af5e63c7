"""Snapshot scans: gzip JSON lines below ``<entity>s/updated_date=YYYY-MM-DD/``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.sources.schemas import ENTITIES, MERGE_LOG

CORRUPT = "_corrupt_record"


def read_snapshot(
    spark: SparkSession,
    root: str,
    entity: str = "work",
    schema: str | None = None,
    since: str | None = None,
    inclusive: bool = True,
    skip: int = 0,
    spread: int | None = None,
) -> DataFrame:
    """Records of one entity; ``schema`` may name a few fields only, the others are never parsed.

    ``since`` prunes partition folders, ``skip`` leaves out the first files in path order. A gzip file is one
    task, so ``spread`` redistributes the parsed records for the steps that follow. Broken lines keep their text
    in ``_corrupt_record``.
    """
    return _scan(spark, [f"{root}/{entity}s"], f"{root}/{entity}s", schema or ENTITIES[entity], since, inclusive, skip, spread)


def stage_snapshot(
    spark: SparkSession, root: str, out: str, entity: str = "work", since: str | None = None, spread: int | None = None
) -> DataFrame:
    """A columnar copy of a snapshot, one folder per update day, broken lines left out.

    Worth its one pass: gzip JSON is neither splittable nor prunable, the copy is both.
    """
    records, _ = split_corrupt(read_snapshot(spark, root, entity, since=since, spread=spread))
    records.write.mode("overwrite").partitionBy("updated_date").parquet(f"{out}/{entity}s")
    return spark.read.parquet(f"{out}/{entity}s")


def _scan(
    spark: SparkSession,
    paths: list[str],
    base: str,
    schema: str,
    since: str | None = None,
    inclusive: bool = True,
    skip: int = 0,
    spread: int | None = None,
) -> DataFrame:
    fields = f"{schema}, {CORRUPT} STRING"
    # the partition folder and a record field share their name; the folder is what the scan is pruned by
    fields = re.sub(r",\s*updated_date STRING", "", fields)
    records = (
        spark.read.schema(f"{fields}, updated_date DATE")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("basePath", base)
        .json(paths)
    )
    if since is not None:
        day = F.lit(since).cast("date")
        records = records.where(F.col("updated_date") >= day if inclusive else F.col("updated_date") > day)
    if skip:
        # Spark has listed the files already; a literal bound on the path prunes them before any is opened
        places = sorted(_clean(path) for path in records.inputFiles())
        last_skipped = places[min(skip, len(places)) - 1]
        records = records.where(_clean_path(F.col("_metadata.file_path")) > last_skipped)
    return records.repartition(spread) if spread else records


def read_pending(
    spark: SparkSession, root: str, ledger: DataFrame, entity: str = "work", schema: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(records of files not in the ledger, the ledger rows to append once those are done).

    File names are driver-side state of any scan; records are not touched to find out what is pending.
    """
    base = f"{root}/{entity}s"
    pending = unprocessed(snapshot_files(spark, base), ledger)
    paths = [row["path"] for row in pending.collect()]
    if not paths:
        return _scan(spark, [base], base, schema or ENTITIES[entity]).where(F.lit(False)), pending
    return _scan(spark, sorted(paths), base, schema or ENTITIES[entity]), pending


def snapshot_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file, from Spark's own listing; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(_clean_path(F.col("path")).alias("path"))


def _clean_path(path: Column) -> Column:
    """One spelling for local paths, which come with one slash or three after the scheme."""
    return F.regexp_replace(path, "^file:/+", "/")


def _clean(path: str) -> str:
    return re.sub("^file:/+", "/", path)


def unprocessed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files not yet in the ledger of finished ones."""
    return files.join(ledger.select("path").distinct(), "path", "left_anti")


def split_corrupt(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable records, quarantined lines with whatever fields could be read).

    Spark does not scan JSON for broken lines alone: read at least one field beside ``_corrupt_record``.
    """
    return records.where(F.col(CORRUPT).isNull()).drop(CORRUPT), records.where(F.col(CORRUPT).isNotNull())


def decode_lines(lines: DataFrame, column: str, schema: str) -> DataFrame:
    """Parse JSON text; a broken line becomes NULL fields plus ``_corrupt_record``, a blank line is dropped."""
    record = F.from_json(
        column, f"{schema}, {CORRUPT} STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    others = [c for c in lines.columns if c != column]
    return lines.where(F.length(F.trim(column)) > 0).select(*others, record.alias("record")).select(*others, "record.*")


def read_merge_log(
    spark: SparkSession, root: str, entity: str = "work", since: str | None = None, inclusive: bool = False
) -> DataFrame:
    """Merged-away records. The day a file stands for is in its name, so whole files are left out."""
    log = spark.read.schema(MERGE_LOG).option("header", "true").csv(f"{root}/merged_ids/{entity}s")
    if since is None:
        return log
    day = F.regexp_extract(F.col("_metadata.file_name"), r"(\d{4}-\d{2}-\d{2})", 1)
    return log.where(day >= since if inclusive else day > since)


def read_id_list(spark: SparkSession, path: str, column: str = "openalex_id") -> DataFrame:
    """Ids of a text file: trimmed, non-empty, distinct."""
    ids = F.trim("value")
    return spark.read.text(path).select(ids.alias(column)).where(F.length(column) > 0).distinct()


def read_id_csv(spark: SparkSession, path: str) -> DataFrame:
    """(openalex_id, doi, pubmed_id) of a CSV file whose ``pmid`` column may be missing."""
    table = spark.read.option("header", "true").csv(path)
    first, second = table.columns[:2]
    pmid = F.col("pmid") if "pmid" in table.columns else F.lit(None).cast("string")
    return table.select(
        F.col(first).cast("string").alias("openalex_id"), F.col(second).cast("string").alias("doi"),
        pmid.cast("string").alias("pubmed_id"),
    )
