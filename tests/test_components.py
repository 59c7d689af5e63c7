"""Connected components against union-find, and batches whose rows share identifiers."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vellum.operators import matching
from vellum.operators.components import connected_components, shared_value_components
from vellum.plans import fixtures


def roots_of(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in parent}


def graphs():
    rng = random.Random(5)
    yield [(i, i + 1) for i in range(40)]  # a path
    yield [(0, i) for i in range(1, 60)] + [(60, i) for i in range(61, 90)] + [(59, 61)]  # two stars and a bridge
    yield [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(None, 3), (3, None), (7, 7), (1, 2), (2, 1)]
    yield [(999, 999)]
    yield []


@pytest.mark.parametrize("pairs", list(graphs()))
def test_components(spark, pairs):
    found = connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    assert {r["node"]: r["root"] for r in found} == roots_of(pairs) and len(found) == len(roots_of(pairs))


ROWS = [
    # a chain A - doi - B - pmid - C, given in the wrong order
    (3, None, "D1", None, "A", None, 5), (1, None, None, "P1", None, "text C", 9), (2, None, "D1", "P1", "B", None, 7),
    # alone, without any identifier, and a pair by one kind only; a value of another kind is no link
    (4, "W4", None, None, "alone", "x", 1), (5, None, None, None, "none", "y", 1), (6, None, None, None, "none", "y", 1),
    (7, "W7", None, None, "first", "old", 2), (8, "W7", None, "D1", None, "new", 2),
]
BATCH = "record_id bigint, openalex_id string, doi string, pubmed_id string, title string, abstract string, t int"
KINDS = ["openalex_id", "doi", "pubmed_id"]


def test_rows_of_a_batch_become_one(spark):
    found = matching.collapse_linked(spark.createDataFrame(ROWS, BATCH), "record_id", ["t", "record_id"], KINDS).collect()
    assert sorted(map(tuple, found)) == [
        (3, None, "D1", "P1", "B", "text C", 9), (4, "W4", None, None, "alone", "x", 1), (5, None, None, None, "none", "y", 1),
        (6, None, None, None, "none", "y", 1), (7, "W7", None, "D1", "first", "new", 2),
    ]


def test_linked_rows_meet_existing_ones_with_all_their_identifiers(spark):
    existing = spark.createDataFrame([(100, None, None, "P1", "kept", None), (101, "W9", None, None, "other", "z")], BATCH.rpartition(",")[0])
    found = matching.merge_batch(existing, spark.createDataFrame(ROWS, BATCH), "record_id", ["t", "record_id"])
    rows = {r["record_id"]: r for r in found.collect()}
    assert set(rows) == {100, 101, 4, 5, 6, 7}
    assert tuple(rows[100])[1:] == (None, "D1", "P1", "B", "text C") and rows[101]["title"] == "other"


def test_merging_a_batch_moves_texts_for_fetching_them_only(spark):
    existing = spark.createDataFrame([(100, None, None, "P1", "kept", None)], BATCH.rpartition(",")[0])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = matching.merge_batch(existing, spark.createDataFrame(ROWS, BATCH), "record_id", ["t", "record_id"])
        plan = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moved = [part for part in plan.split("\n\n") if re.match(r"\(\d+\) Exchange", part.strip()) and re.search(r"\b[vn_]*abstract#", part)]
    assert len(moved) == 2  # what is offered, the rows of the result; what was fetched has other names


def test_merging_a_batch_takes_the_last_of_rows_with_one_key(spark):
    existing = spark.createDataFrame([(100, None, None, "P1", "kept", None), (100, None, None, "P1", "kept too", None)], BATCH.rpartition(",")[0])
    batch = [(1, None, None, "P1", "z", "z", None), (1, None, None, "P1", "b", None, 2), (9, None, None, None, "n", "x", 3), (9, None, None, None, "n", "x", 3)]
    found = matching.merge_batch(existing, spark.createDataFrame(batch, BATCH), "record_id", ["t", "record_id"]).collect()
    assert sorted((r["record_id"], r["title"], r["abstract"]) for r in found) == [(9, "n", "x"), (9, "n", "x"), (100, "b", "z"), (100, "b", "z")]


def test_sources_join_documents_whose_id_comes_again(spark, tmp_path):
    docs = [(1, "a", "en", "src1", 3), (1, "b", "fr", "src7", 4), (2, "c", "de", None, 5), (None, "d", "es", "src2", 6), (3, "e", "en", "src7", 7)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    found = fixtures.request_sources(spark, str(tmp_path))
    named = fixtures.table(spark, str(tmp_path), "documents").select(F.col("doc_id").alias("_doc"), "source")
    wanted = fixtures.request(spark, str(tmp_path)).join(named, F.expr("record_id div 4 = _doc")).select(*found.columns)
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, wanted.collect())) and found.count() == 24


def test_placeholder_on_a_third_of_the_rows(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("record_id"), F.when(F.col("id") % 3 == 0, "pending").otherwise(F.concat(F.lit("d"), F.col("id").cast("string"))).alias("doi")
    )
    found = shared_value_components(rows, "record_id", ["doi"])
    assert found.count() == 1000 and found.select("root").distinct().count() == 1
