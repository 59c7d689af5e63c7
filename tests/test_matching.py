"""Any-identifier matching against brute force, with a value that fills a third of both tables."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from vellum.operators import matching

KINDS = ("doi", "openalex_id", "pubmed_id", "s2_id")
SCHEMA = "record_id int, wrapper string, " + ", ".join(f"{k} string" for k in KINDS) + ", abstract string, time_created int"


def tables(seed, n=60):
    rng = random.Random(seed)

    def ids():
        values = [rng.choice([None, "p1", "p2", "p|3", "4:p"]) for _ in KINDS]
        if rng.random() < 1 / 3:
            values[0] = "hot"
        return values

    request = [
        (i, rng.choice("AB"), *ids(), rng.choice([None, f"text {i}"]), rng.randint(0, 5)) for i in range(n)
    ]
    queue = [(i, *ids()) for i in range(n // 2)]
    return queue, request


def agree(q, r):
    return any(a is not None and a == b for a, b in zip(q[1:5], r[2:6]))


@pytest.fixture(scope="module", params=[1, 2, 3])
def data(request, spark):
    queue, cache = tables(request.param)
    schema = "queue_id int, " + ", ".join(f"{k} string" for k in KINDS)
    return queue, cache, spark.createDataFrame(queue, schema), spark.createDataFrame(cache, SCHEMA)


def test_counts_equal_or_join(data):
    queue, cache, left, right = data
    conditions = {"n": F.lit(True), "n_text": F.col("abstract").isNotNull(), "n_a": F.col("wrapper") == "A"}
    found = matching.count_matches(left, right, "queue_id", conditions)
    expected = {}
    for q in queue:
        rows = [r for r in cache if agree(q, r)]
        if rows:
            expected[q[0]] = (len(rows), sum(r[6] is not None for r in rows), sum(r[1] == "A" for r in rows))
    assert {r["queue_id"]: (r["n"], r["n_text"], r["n_a"]) for r in found.collect()} == expected


def test_lookup_is_whole(data):
    queue, cache, left, right = data
    found = {r["record_id"] for r in matching.lookup_records(left, right).collect()}
    assert found == {r[0] for r in cache if any(agree(q, r) for q in queue)}


@pytest.mark.parametrize("empty_is_missing", [False, True])
def test_status(data, empty_is_missing):
    queue, cache, left, right = data
    status = matching.lookup_status(left, right, "queue_id", empty_is_missing).collect()
    for row, q in zip(sorted(status, key=lambda r: r["queue_id"]), queue):
        rows = sorted((r[7], r[0], r[6]) for r in cache if agree(q, r)) if not empty_is_missing else sorted(
            ((r[7], r[0], r[6] or "") for r in cache if agree(q, r))
        )
        hits = [r for r in rows if r[2]] if empty_is_missing else rows
        assert row["hit"] == bool(hits)
        assert row["missed"] != row["hit"]
        assert row["record_id"] == ((hits or rows)[0][1] if rows else None)


def test_cascade(data):
    queue, cache, left, right = data
    found = {r["queue_id"]: (r["record_id"], r["abstract"]) for r in
             matching.cascade(left, right, "queue_id", ("B", "A")).collect()}
    for q in queue:
        rows = sorted(("BA".index(r[1]), r[7], r[0], r[6]) for r in cache if agree(q, r) and r[6])
        assert found[q[0]] == ((rows[0][2], rows[0][3]) if rows else (None, None))


def test_complete_ids_follows_the_cascade(spark, data):
    queue, cache, left, right = data
    timed = left.withColumn("time_created", F.col("queue_id") % 7)
    found = {r["record_id"]: tuple(r[k] for k in KINDS)
             for r in matching.complete_ids(right, timed, KINDS).collect()}
    ordered = sorted(queue, key=lambda q: (q[0] % 7, q[0]))
    for r in cache:
        own = list(r[2:6])
        for i in range(len(KINDS)):
            if own[i] is None:
                continue
            for q in ordered:
                if q[1 + i] == own[i]:
                    for j in range(len(KINDS)):
                        if own[j] is None and q[1 + j] is not None:
                            own[j] = q[1 + j]
        assert found[r[0]] == tuple(own)


@pytest.mark.parametrize("null_equal", [False, True])
def test_skip_existing(data, null_equal):
    queue, cache, left, right = data
    kinds = KINDS[1:3]
    kept = {r["queue_id"] for r in
            matching.skip_existing(left, right, "queue_id", "A", kinds, null_equal).collect()}
    places = [1 + KINDS.index(k) for k in kinds]

    def same(a, b):
        return a == b and (null_equal or a is not None)

    expected = {
        q[0] for q in queue
        if not any(same(q[p], r[1 + p]) for r in cache if r[1] == "A" for p in places)
    }
    assert kept == expected


def test_merge_any_id(spark):
    old = spark.createDataFrame(
        [(1, "d1", None, "old"), (2, None, "w2", None), (3, "d3", "w3", "old")],
        "record_id int, doi string, openalex_id string, abstract string",
    )
    new = spark.createDataFrame(
        [(1, "d1", "w1", "new", 1), (2, "d1", None, "newer", 2), (3, None, "w2", None, 3), (4, "d9", None, "added", 4)],
        "n int, doi string, openalex_id string, abstract string, t int",
    )
    merged = matching.merge_any_id(old, new, "n", ["t"]).collect()
    found = {tuple(r[c] for c in ("record_id", "doi", "openalex_id", "abstract")) for r in merged}
    assert found == {
        (1, "d1", "w1", "newer"), (2, None, "w2", None), (3, "d3", "w3", "old"), (None, "d9", None, "added"),
    }


def test_repair_keeps_the_largest_listed_id(spark):
    request = spark.createDataFrame(
        [(1, None, "10.1/A"), (2, "W9", "10.1/a"), (3, None, None), (4, None, "10.1/zz")],
        "record_id int, openalex_id string, doi string",
    )
    catalogue = spark.createDataFrame(
        [("https://openalex.org/w1", "https://doi.org/10.1/a"), ("https://openalex.org/W2", "https://doi.org/10.1/A"),
         ("https://openalex.org/W3", "https://doi.org/10.1/a")], "id string, doi string",
    )
    references = spark.createDataFrame([("W1",), ("W2",)], "openalex_id string")
    found = matching.repair_ids(request, catalogue, references).collect()
    assert {(r["record_id"], r["openalex_id"]) for r in found} == {(1, "W2"), (2, "W9"), (3, None), (4, None)}


def test_subset_keys_do_not_collide(spark):
    # identifiers that contain the separators
    left = spark.createDataFrame([(1, "a|1:1:b", None), (2, "a", "b")], "queue_id int, doi string, openalex_id string")
    right = spark.createDataFrame([(1, "a", "b")], "record_id int, doi string, openalex_id string")
    found = matching.count_matches(left, right, "queue_id", {"n": F.lit(True)}).collect()
    assert {(r["queue_id"], r["n"]) for r in found} == {(2, 1)}


def test_all_eight_kinds(spark):
    from vellum.functions.ids import ID_COLUMNS

    rng = random.Random(5)
    rows = [[rng.choice([None, "x", "y"]) for _ in ID_COLUMNS] for _ in range(24)]
    schema = ", ".join(f"{k} string" for k in ID_COLUMNS)
    left = spark.createDataFrame([(i, *r) for i, r in enumerate(rows[:12])], f"queue_id int, {schema}")
    right = spark.createDataFrame([(i, *r) for i, r in enumerate(rows[12:])], f"record_id int, {schema}")
    found = {r["queue_id"]: r["n"] for r in matching.count_matches(left, right, "queue_id", {"n": F.lit(1) == 1}).collect()}
    expected = {}
    for (i, q), r in itertools.product(enumerate(rows[:12]), rows[12:]):
        if any(a is not None and a == b for a, b in zip(q, r)):
            expected[i] = expected.get(i, 0) + 1
    assert found == expected
