"""A corpus pipeline: keep documents of known language and good quality, one of each near-duplicate group, pack them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.common import fold, read_table, row_key, write_shared
from vellum.llm.language import fit_language, keep_recognised
from vellum.llm.neardup import near_duplicates
from vellum.llm.packing import pack, word_length
from vellum.llm.quality import fit_quality, keep_good

#: A document below these scores is rejected.
LANGUAGE, QUALITY = 0.4, 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those whose language is not recognised."""
    return keep_recognised(docs, fit_language(docs, where=fold("doc_id", 4) != 2), LANGUAGE)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of low quality."""
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"), where=fold("doc_id", 4) != 2)
    return keep_good(docs, model, QUALITY)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each near-duplicate class, repeated rows once.

    Documents without id come after all others, in the order of a hash of their texts.
    """
    keyed = docs.withColumn("row_key", row_key())
    ids = near_duplicates(keyed, "row_key").filter("doc_id = class_id").select(F.col("doc_id").alias("row_key")).distinct()
    return keyed.join(ids, "row_key", "left_semi").dropDuplicates(["row_key"]).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every document in training sequences; each is the only one of its class, so clusters can't conflict."""
    return pack(docs, word_length(), F.col("source"), F.lit(None))


STAGES = [("language", language), ("quality", quality), ("near_dedup", near_dedup), ("packing", packing)]

#: The stages learn, sample and place step by step, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next one."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), name)
    return docs
