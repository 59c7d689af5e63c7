"""The jobs from end to end."""

import gzip
import json
import tempfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vellum import jobs
from vellum.operators import queueing
from vellum.operators.flatten import FLATTENERS, flatten_entity
from vellum.sources import snapshot, writers
from vellum.sources.schemas import ENTITIES

STAMP = datetime(2024, 6, 1)


def now():
    return F.lit(STAMP).cast("timestamp_ntz")


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def work(n, day, **fields):
    return day, {"id": f"https://openalex.org/W{n}", "title": f"t{n}", "doi": f"https://doi.org/10.1/{n}", **fields}


@pytest.fixture(scope="module")
def folder():
    root = Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    works = [
        work(1, "2024-01-01", abstract_inverted_index={"old": [0], "text": [1]}),
        work(1, "2024-01-02", abstract_inverted_index={"new": [0], "text": [1]},
             authorships=[{"author": {"id": "https://openalex.org/A1"}, "institutions": [{"id": "https://openalex.org/I1"}]}],
             referenced_works=["https://openalex.org/W2"], is_xpac=False),
        work(2, "2024-01-02", is_xpac=False, open_access={"is_oa": True}, ids={"mag": 5, "pmid": "7"}),
        work(3, "2024-01-02", is_xpac=True, biblio={"volume": "1", "issue": None}),
    ]
    for day, record in works:
        path = root / "works" / f"updated_date={day}" / "part_000.gz"
        path.parent.mkdir(parents=True, exist_ok=True)
        with gzip.open(path, "at") as out:
            out.write(json.dumps(record) + "\n")
    return root


@pytest.fixture(scope="module")
def works(spark, folder):
    return snapshot.stage_snapshot(spark, str(folder), f"{folder}/staged", spread=3)


@pytest.fixture(scope="module")
def index(works):
    return jobs.ingest(None, works)


def test_ingest_takes_the_newest_record(index):
    assert rows(index, "id", "abstract", "mag", "is_oa", "biblio") == [
        ("W1", "new text", None, None, None), ("W2", None, "5", True, None), ("W3", None, None, None, '{"volume":"1"}'),
    ]
    assert rows(index, "id", "abstract_source") == [("W1", "OpenAlex"), ("W2", None), ("W3", None)]


def test_ingest_again_changes_nothing(works, index):
    again = jobs.ingest(index, works)
    assert rows(again, *index.columns) == rows(index, *index.columns)


def test_collections(works):
    assert rows(jobs.ingest(None, works, "xpac"), "id") == [("W3",)]
    # an unmarked record is a base one
    assert rows(jobs.ingest(None, works, "base"), "id") == [("W1",), ("W2",)]


def cache(spark):
    return spark.createDataFrame(
        [(1, "WOS", "W2", "a", "from wos", None), (2, "SCOPUS", "W2", "b", "from scopus", None),
         (3, "WOS", "W1", "c", "other", None), (4, "WOS", "W9", "d", "unknown work", None),
         (5, "PUBMED", "W3", "e", None, None), (6, "WOS", "W3", "f", "failed before", False)],
        "record_id int, wrapper string, openalex_id string, title string, abstract string, solarized boolean",
    ).withColumn("time_created", now())


def test_transfer(spark, index):
    following, request, counters = jobs.transfer(index, cache(spark), now())
    assert rows(following, "id", "title", "abstract", "abstract_source", "abstract_date") == [
        ("W1", "t1", "new text", "OpenAlex", None), ("W2", "a", "from wos", "WOS", STAMP), ("W3", "t3", None, None, None),
    ]
    assert rows(request, "record_id", "solarized") == [
        (1, True), (2, True), (3, True), (4, True), (5, None), (6, False),
    ]
    assert tuple(counters.first()) == (3, 2)
    # nothing is left to transfer
    assert tuple(jobs.transfer(following, request, now())[2].first()) == (0, 0)


def test_daily_update_queues_what_lacks_an_abstract(spark, index):
    update = index.where("id <> 'W3'").withColumn("abstract", F.lit(None).cast("string"))
    following, entries = jobs.daily_update(index, update, now())
    assert rows(following, "id", "abstract", "abstract_source") == [
        ("W1", "new text", "OpenAlex_old"), ("W2", None, None), ("W3", None, None),
    ]
    assert rows(entries, "openalex_id", "doi", "sources") == [("W1", "10.1/1", None), ("W2", "10.1/2", None)]


def test_match_old_snapshot(spark, folder, index):
    old = snapshot.read_snapshot(spark, str(folder), schema="id STRING, abstract_inverted_index MAP<STRING, ARRAY<INT>>")
    emptied = index.withColumn("abstract", F.lit(None).cast("string"))
    following, cache_rows, counters = jobs.match_old_snapshot(old, emptied, now())
    assert rows(following, "id", "abstract", "abstract_source") == [
        ("W1", "old text", "OpenAlex_old"), ("W2", None, None), ("W3", None, None),
    ]
    assert rows(cache_rows, "openalex_id", "abstract") == [("W1", "old text")]
    assert tuple(counters.first()) == (3, 1, 1, 1)


def queue(spark):
    return spark.createDataFrame([(1, "W3")], "queue_id bigint, openalex_id string")


def test_queue_missing(spark, index):
    dated = index.withColumn("created_date", F.lit("2024-05-05"))
    request = cache(spark).where("openalex_id <> 'W2'")
    entries = jobs.queue_missing(dated, request, queue(spark), "2024-05-05", "2024-05-05", now())
    assert rows(entries, "openalex_id", "doi", "pubmed_id", "sources") == [("W2", "10.1/2", "7", None)]
    assert jobs.queue_missing(dated, request, queue(spark), "2024-05-06", "2024-05-07", now()).count() == 0
    assert jobs.queue_missing(dated, cache(spark), queue(spark), "2024-05-05", "2024-05-05", now()).count() == 0


def test_queue_ids(spark, index):
    ids = spark.createDataFrame([("W1",), ("W2",), ("W3",), ("W8",)], "openalex_id string")
    bare = index.withColumn("doi", F.when(F.col("id") != "W3", F.col("doi")))
    entries, counters = jobs.queue_ids(bare, ids, now())
    assert rows(entries, "openalex_id", "doi") == [("W2", "10.1/2")]
    assert [tuple(s) for s in entries.first()["sources"]] == list(queueing.GAP_SOURCES)
    assert tuple(counters.first()) == (4, 2, 1)


def test_sample(index):
    assert rows(jobs.sample_ids(index, 10), "id") == [("W1",), ("W2",)]
    assert rows(jobs.sample_ids(index, 10, include_xpac=True), "id") == [("W1",), ("W2",), ("W3",)]
    assert rows(jobs.sample_ids(index, 10, ensure_abstract=True), "id") == [("W1",)]


def test_tables_after_an_update(spark, folder, works):
    first = flatten_entity(works.where("updated_date = '2024-01-01'"), "work")
    after = jobs.update_tables(first, works.where("updated_date = '2024-01-02'"), "work")
    assert rows(after["works"], "work_id", "abstract") == [("W1", "new text"), ("W2", None), ("W3", None)]
    assert rows(after["works_authorship_institutions"], "work_id", "author_id", "institution_id") == [("W1", "A1", "I1")]
    assert rows(after["works_references"], "src_work_id", "trgt_work_id") == [("W1", "W2")]
    writers.write_tables(after, f"{folder}/tables")
    assert spark.read.parquet(f"{folder}/tables/works").count() == 3


@pytest.mark.parametrize("entity", sorted(ENTITIES))
def test_flatten_survives_empty_records(spark, entity):
    empty = spark.createDataFrame([("{}",)], "v string").select(F.from_json("v", ENTITIES[entity]).alias("r")).select("r.*")
    tables = flatten_entity(empty, entity)
    assert set(tables) and entity in FLATTENERS
    for name, table in tables.items():
        assert table.count() <= 1, name


def test_the_newest_record_wins_in_whatever_order_batches_come(spark):
    from vellum.session import scratch_path
    from vellum.sources.writers import append_batch, read_log

    root = scratch_path(spark, "log")
    for batch, day, title in ((0, "2024-01-02", "b"), (1, "2024-01-03", "newest"), (2, "2024-01-01", "stale"), (3, "2024-01-03", "again")):
        append_batch(spark.createDataFrame([("W1", day, title)], "id string, updated_date string, title string"), root, batch)
    state = {"key": "id", "order": ("updated_date",)}
    schema = "id STRING, updated_date STRING, title STRING"
    assert [r["title"] for r in read_log(spark, root, schema, **state).collect()] == ["again"]
    assert [r["title"] for r in read_log(spark, root, schema, before=3, **state).collect()] == ["newest"]


def test_a_limit_counts_new_entries_only(spark):
    from vellum import jobs
    from vellum.operators import queueing as q

    index = spark.createDataFrame(
        [(f"W{i}", None, f"10.1/{i}", "2024-01-05", "2024-01-05") for i in range(6)],
        "id string, abstract string, doi string, created_date string, updated_date string",
    )
    request = spark.createDataFrame([("W0", "known"), ("W1", "known"), ("W2", "known")], "openalex_id string, abstract string")
    queue = spark.createDataFrame([], f"queue_id bigint, openalex_id string, sources {q.SOURCES_TYPE}")
    now = F.lit(datetime(2024, 1, 1))
    found = jobs.queue_missing(index, request, queue, "2024-01-01", "2024-01-31", now, limit=2)
    assert [r["openalex_id"] for r in found.orderBy("openalex_id").collect()] == ["W3", "W4"]
    assert jobs.queue_missing(index, request, queue, "2024-01-01", "2024-01-31", now).count() == 3


def test_payloads_without_adapter_stay(spark):
    from vellum.operators import payloads

    rows = spark.createDataFrame([(1, "SCOPUS", '{"eid":"x"}'), (2, "WOS", "w"), (3, None, "n")], "id int, wrapper string, raw string")
    found = {r["id"]: (r["wrapper"], r["scopus_id"], r["raw"]) for r in payloads.unify_all(rows).collect()}
    assert found == {1: ("SCOPUS", "x", '{"eid":"x"}'), 2: ("WOS", None, "w"), 3: (None, None, "n")}


def test_records_without_work_are_not_collapsed(spark):
    from vellum.operators import reports

    rows = spark.createDataFrame(
        [(1, None, "a", 1), (2, None, "b", 2), (3, "W1", None, 1), (4, "W1", "c", 2)], "record_id int, openalex_id string, title string, time_created int"
    )
    assert [tuple(r) for r in reports.collapse_records(rows, ["title"]).collect()] == [("W1", "c")]


def test_samples_do_not_depend_on_partitions(spark):
    from vellum.operators import reports

    ids = spark.range(5000).withColumn("id", F.col("id").cast("string"))
    first = [r["id"] for r in reports.seeded_sample(ids, "id", 700, 5).collect()]
    assert first == [r["id"] for r in reports.seeded_sample(ids.repartition(13), "id", 700, 5).collect()]
    assert len(set(first)) == 700 and reports.seeded_sample(ids, "id", 9000, 5).count() == 5000


def test_group_counts_are_spread(spark):
    from vellum.operators import reports

    rows = spark.range(1000).withColumn("k", F.when(F.col("id") > 300, "hot").when(F.col("id") > 10, F.col("id").cast("string")))
    found = reports.with_group_count(rows, "k").groupBy("k").agg(F.max("n").alias("n"), F.count("*").alias("m")).collect()
    assert all(r["n"] == r["m"] for r in found) and len(found) == 292
