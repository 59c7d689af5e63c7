"""Stored tables that change in place: results against plain dictionaries, files against what was hit."""

import random

import pytest
from pyspark.sql import functions as F

from vellum.operators.upsert import upsert
from vellum.plans import fixtures, streams
from vellum.sources import keyed
from vellum.sources.keyed import KeyedLog, RangeTable

SCHEMA = "id string, day int, text string"


def batches(seed, n=14):
    rng = random.Random(seed)
    for batch in range(n):
        keys = rng.sample(range(60), rng.choice([1, 3, 20]))
        yield batch, [(f"k{k}" if k else None, rng.randint(0, 5), f"{batch}-{k}") for k in keys]


def state(rows):
    return {r["id"]: (r["day"], r["text"]) for r in rows.collect()}


def test_log_against_a_dictionary(spark, tmp_path):
    root = str(tmp_path / "log")
    log = KeyedLog(spark, root, "id", SCHEMA, ("day",), buckets=4, fan=3)
    assert log.read().count() == 0
    expected, before, most = {}, {}, 0
    for batch, rows in batches(1):
        before[batch] = dict(expected)
        log.append(spark.createDataFrame(rows, SCHEMA), batch)
        for key, day, text in rows:
            if key not in expected or day >= expected[key][0]:
                expected[key] = (day, text)
        most = max(most, log.deltas())
    assert state(log.read()) == expected
    assert most <= 6 and len(list(batches(1))) == 14  # merged on the way
    # a batch that comes again changes nothing, and sees the log as it was
    last, rows = list(batches(1))[-1]
    log.append(spark.createDataFrame([("k1", 99, "replayed")], SCHEMA), last)
    assert state(log.read()) == expected and state(log.read(before=last)) == before[last]
    # reopened by another reader, with the buckets of the table
    again = KeyedLog(spark, root, "id", SCHEMA, ("day",))
    assert again.buckets == 4 and state(again.read()) == expected
    again.forget(keep=1)
    assert state(again.read()) == expected and again.forget(keep=1) == 0


def test_log_opens_the_buckets_of_the_keys_only(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path), "id", SCHEMA, ("day",), buckets=32)
    for batch in range(2):
        log.append(spark.range(2000).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(batch).alias("day"), F.lit("t").alias("text")), batch)
    only = spark.createDataFrame([("k5",), ("k77",), ("unknown",)], "id string")
    found = log.read(only=only)
    folders = {f.rpartition("/")[0].rpartition("/")[2] for f in found.inputFiles()}
    assert len(folders) <= 3 and len(log.read().inputFiles()) >= 64
    assert state(found) == {"k5": (1, "t"), "k77": (1, "t")}


def test_log_is_not_shuffled_to_find_keys(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path), "id", SCHEMA, ("day",), buckets=4)
    for batch in range(3):
        log.append(spark.range(200).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(batch).alias("day"), F.lit("t").alias("text")), batch)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = log.read(only=spark.createDataFrame([(f"k{i}", "x" * 1000) for i in range(150, 250)], "id string, text string"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert state(found) == {f"k{i}": (2, "t") for i in range(150, 200)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_whole_log_is_read_without_a_shuffle_of_its_texts(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path), "id", SCHEMA, ("day",), buckets=4)
    log.append(spark.createDataFrame([(f"k{i}", 5, "old") for i in range(50)] + [(None, 1, "old")], SCHEMA), 0)
    log.append(spark.createDataFrame([("k1", 6, "new"), ("k2", 5, "new"), ("k3", 4, "stale"), ("k4", None, "undated"), (None, 2, "new")], SCHEMA), 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = log.read()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "SortMergeJoin" not in plan
        expected = {f"k{i}": (5, "old") for i in range(50)} | {"k1": (6, "new"), "k2": (5, "new"), None: (2, "new")}
        assert found.count() == 51 and state(found) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_key_that_a_batch_has_twice_is_one_row(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path), "id", SCHEMA, ("day",), buckets=2)
    log.append(spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("b", 1, "x"), ("c", 1, "x"), (None, 1, "x"), (None, 1, "x")], SCHEMA), 0)
    log.append(spark.createDataFrame([("a", 0, "y"), ("b", 2, "y")], SCHEMA), 1)
    assert log.read().count() == 4
    assert state(log.read()) == {"a": (1, "x"), "b": (2, "y"), "c": (1, "x"), None: (1, "x")}


def test_large_batches_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "PART_ROWS", 20)
    log = KeyedLog(spark, str(tmp_path), "id", SCHEMA, ("day",), buckets=2, fan=2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for batch in range(2):  # the second one is merged with the first
            rows = spark.range(400).select(F.concat(F.lit("k"), "id").alias("id"), F.lit(batch).alias("day"), F.lit("t").alias("text"))
            log.append(rows, batch, 400)
            assert len({f for f in log.read().inputFiles() if "_bucket=0" in f}) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert log.deltas() == 1 and state(log.read()) == {f"k{i}": (1, "t") for i in range(400)}


def test_days_are_published_in_files_that_follow_rows_not_tasks(spark, tmp_path, monkeypatch):
    rows = spark.range(0, 600, 1, 12).selectExpr(
        "CASE WHEN id % 50 > 0 THEN concat('W', id) END AS id", "concat('D', id) AS doi", "'t' AS title", "DATE '2024-04-01' + CAST(id % 3 AS INT) AS updated_date"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for folder, most, files in (("one", 1000, (3, 3)), ("more", 200, (4, 9))):
            monkeypatch.setattr(streams, "DAY_ROWS", most)
            streams.publish_days(rows, f"{tmp_path}/{folder}")
            found = spark.read.parquet(f"{tmp_path}/{folder}")
            assert files[0] <= len(found.inputFiles()) <= files[1] and found.where("day = updated_date").count() == 600
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_short_labels_go_to_the_texts(spark, tmp_path):
    spark.createDataFrame([(1, "text", "en", "src1", 4), (2, "text", "en", "src1", 4)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = fixtures.update(spark, str(tmp_path))
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
        assert [(r["id"], r["abstract"]) for r in found.collect()] == [("W1", "text")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows_of(spark, keys, mark):
    return spark.createDataFrame([(k, f"{mark}{k}", None if k % 3 else "x") for k in keys], "id bigint, a string, b string")


def plain(rows):
    return sorted(((r["id"], r["a"], r["b"]) for r in rows.collect()), key=str)


@pytest.mark.parametrize("mode", ["replace", "patch", "coalesce"])
def test_table_against_whole_rewrites(spark, tmp_path, mode):
    table = RangeTable(spark, str(tmp_path), "id", rows=50)
    whole = rows_of(spark, range(0, 1000, 2), "a").unionByName(spark.createDataFrame([(None, "n", "n")], "id bigint, a string, b string"))
    table.create(whole)
    for keys in ([10, 11, 12], range(990, 1100), [], [3]):
        new = rows_of(spark, list(keys), f"{mode}-")
        table.upsert(new, mode)
        whole = upsert(whole, new, "id", mode)
        assert plain(table.read()) == plain(whole)
    gone = spark.createDataFrame([(12,), (14,), (5000,)], "id bigint")
    table.delete(gone)
    assert plain(table.read()) == plain(whole.where("id IS NULL OR id NOT IN (12, 14)"))
    assert plain(table.read(100, 120)) == plain(whole.where("id BETWEEN 100 AND 120"))
    assert len(table.read(100, 120).inputFiles()) <= 3 < len(table.read().inputFiles())


def test_files_written_follow_files_hit(spark, tmp_path):
    table = RangeTable(spark, str(tmp_path), "id", rows=100)
    table.create(rows_of(spark, range(10_000), "a"))
    files = {e["file"] for e in table.manifest.latest().entries}
    assert 80 <= len(files) <= 120
    # one key in a hundred, close together: a hundred keys in one or two files
    hit = table.upsert(rows_of(spark, range(5_000, 5_100), "new"))
    after = {e["file"] for e in table.manifest.latest().entries}
    assert hit <= 3 and len(after - files) <= hit and len(files - after) == hit
    assert table.read().where("a LIKE 'new%'").count() == 100 and table.read().count() == 10_000
    # keys that no file holds become a file of their own and no other is touched
    assert table.upsert(rows_of(spark, range(20_000, 20_010), "new")) == 0
    assert len({e["file"] for e in table.manifest.latest().entries} - after) == 1
    old = table.manifest.read(1)
    assert len(old.entries) == len(files)
    assert table.forget(keep=1) == 1 or table.read().count() == 10_010  # files of the first version that are still in use stay
    assert table.read().count() == 10_010


def test_only_files_in_range_are_looked_at(spark, tmp_path):
    table = RangeTable(spark, str(tmp_path), "id", rows=100)
    table.create(rows_of(spark, range(1_000), "a"))
    found = table.rows_of(spark.createDataFrame([(250,), (251,), (None,)], "id bigint"))
    assert len(found.inputFiles()) <= 2 and sorted(r["id"] for r in found.collect()) == [250, 251]
    with pytest.raises(ValueError):
        RangeTable(spark, str(tmp_path / "none"), "id").read()
