"""The queue state machine."""

import itertools
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vellum import jobs
from vellum.operators import queueing as q
from vellum.plans import fixtures as fx
from vellum.plans.queue_jobs import responses
from vellum.sources import writers

START = datetime(2024, 1, 1)
IDS = "doi string, openalex_id string, pubmed_id string"
QUEUE = f"queue_id bigint, {IDS}, sources {q.SOURCES_TYPE}, on_conflict int, time_created timestamp_ntz"
CACHE = f"record_id bigint, wrapper string, {IDS}, title string, abstract string, raw string, time_created timestamp_ntz"


def test_eligibility_truth_table(spark):
    cases = list(itertools.product((1, 2), (1, 2, 3, 4), (0, 1), (0, 1), (0, 1)))
    schema = (
        "priority int, on_conflict int, num_has_abstract int, num_has_source_raw int, num_has_source_request int"
    )
    found = spark.createDataFrame(cases, schema).withColumn("ok", q.is_eligible()).collect()
    for priority, policy, abstracts, raws, requests, ok in found:
        wanted = {
            q.CONFLICT_FORCE: True,
            q.CONFLICT_DO_NOTHING: requests == 0,
            q.CONFLICT_RETRY_ABSTRACT: abstracts == 0,
            q.CONFLICT_RETRY_RAW: raws == 0,
        }
        assert ok == (priority == q.SOURCE_FORCE or wanted[policy])


def test_sources_round_trip(spark):
    row = spark.createDataFrame([('[["SCOPUS", 2], ["WOS", 1]]',), ("[]",), (None,)], "s string")
    parsed = row.select(q.format_sources(q.parse_sources(F.col("s"))).alias("s"))
    assert [r["s"] for r in parsed.collect()] == ['[["SCOPUS",2],["WOS",1]]', "[]", None]


def test_advance(spark):
    lists = [("SCOPUS", 2), ("PUBMED", 2), ("WOS", 1)]
    taken = spark.createDataFrame([(1, lists), (2, lists), (3, [("SCOPUS", 1)])], f"queue_id int, sources {q.SOURCES_TYPE}")
    found = spark.createDataFrame([(1,), (1,)], "queue_id int")
    rows = {r["queue_id"]: [tuple(s) for s in r["sources"]] for r in q.advance(taken, found, "SCOPUS").collect()}
    assert rows == {1: [("WOS", 1)], 2: [("PUBMED", 2), ("WOS", 1)], 3: []}


def test_drop_finished_keeps_entries_without_list(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [("A", 1)])], f"queue_id int, sources {q.SOURCES_TYPE}")
    assert sorted(r["queue_id"] for r in q.drop_finished(rows).collect()) == [1, 3]


def test_a_guard_raises_before_anything_is_taken(spark):
    assert q.at_most(spark.range(100), 100).count() == 100
    with pytest.raises(ValueError):
        q.at_most(spark.range(101), 100)


def test_capped(spark):
    rows = spark.range(10)
    assert [r["id"] for r in q.capped(rows, 3, ["id"]).collect()] == [0, 1, 2]
    assert q.capped(spark.range(150_000), 120_000, ["id"]).count() == 120_000
    with pytest.raises(ValueError):
        q.capped(rows, -1, ["id"])


def test_numbers_are_new_and_stable(spark):
    old = spark.createDataFrame([(7,)], "queue_id bigint")
    fresh = q.number_entries(spark.range(100).repartition(5).withColumnRenamed("id", "n"), old)
    first, second = (sorted(map(tuple, fresh.collect())) for _ in range(2))
    assert first == second
    assert len({r[1] for r in first}) == 100 and min(r[1] for r in first) > 7


def test_batches_hold_every_entry_once(spark):
    entries = spark.range(103).select(
        F.col("id").alias("queue_id"),
        F.concat(F.lit("10.1/"), F.col("id").cast("string")).alias("doi"),
        F.lit(None).cast("string").alias("pubmed_id"),
        F.lit(START).cast("timestamp_ntz").alias("time_created"),
    )
    batches = q.lookup_batches(entries, "PUBMED", 10).collect()
    assert sorted(b["n_entries"] for b in batches) == [3, *[10] * 10]
    clauses = [c for b in batches for c in b["clause"].split(" OR ")]
    assert sorted(clauses) == sorted(f'"10.1/{i}"[DOI]' for i in range(103))


def test_batches_follow_the_order_of_a_long_queue(spark):
    n = 250_000
    entries = spark.range(n).repartition(7).select(
        F.col("id").alias("queue_id"), F.col("id").cast("string").alias("doi"),
        (F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(secs=(F.lit(n) - F.col("id")).cast("decimal(18,6)"))).alias("time_created"),
    )
    batches = q.lookup_batches(entries, "PUBMED", 100)
    listed = batches.select("batch", "n_entries", F.explode(F.split("clause", " OR ")).alias("c"))
    number = F.regexp_extract("c", '"(\\d+)"', 1).cast("long")
    wrong = listed.where((F.col("n_entries") != 100) | (F.floor((F.lit(n - 1) - number) / 100) != F.col("batch")))
    assert batches.count() == n // 100 and wrong.count() == 0


def test_clauses(spark):
    entries = spark.createDataFrame(
        [(1, "10.1/a", "5", "S1", "W1", "D1", START), (2, None, "6", None, None, None, START)],
        "queue_id int, doi string, pubmed_id string, scopus_id string, wos_id string, dimensions_id string, "
        "time_created timestamp_ntz",
    )
    clause = {s: q.lookup_batches(entries, s, 25).first()["clause"] for s in ("SCOPUS", "WOS", "DIMENSIONS", "PUBMED")}
    assert clause == {
        "SCOPUS": 'EID(S1) OR DOI("10.1/a")',
        "WOS": 'DO=("10.1/a") OR PMID=(5 OR 6) OR UT=(W1)',
        "DIMENSIONS": 'doi in ["10.1/a"] or id in ["D1"] or pmid in ["5","6"]',
        "PUBMED": '"5"[PMID] OR "6"[PMID] OR "10.1/a"[DOI]',
    }


def simulate(queue, cache, answers, min_length=25):
    """One turn, one entry at a time, as an independent check."""
    queue = {e["queue_id"]: dict(e) for e in queue}
    landed = []
    kinds = ("doi", "openalex_id", "pubmed_id")

    def match(a, b):
        return any(a[k] is not None and a[k] == b[k] for k in kinds)

    for e in queue.values():
        if e["sources"] is None:
            e["sources"] = list(q.DEFAULT_SOURCES)
    head = {i: e["sources"][0][0] for i, e in queue.items() if e["sources"]}
    found = set()
    for source in sorted(set(head.values())):
        taken = sorted((queue[i] for i, s in head.items() if s == source), key=lambda e: (e["time_created"], e["queue_id"]))
        asked = []
        for e in taken:
            rows = [r for r in cache if match(e, r)]
            own = [r for r in rows if r["wrapper"] == source]
            if (
                e["sources"][0][1] == 1
                or e["on_conflict"] == 1
                or (e["on_conflict"] == 3 and not any(r["abstract"] for r in rows))
                or (e["on_conflict"] == 4 and not any(r["raw"] for r in own))
                or (e["on_conflict"] == 2 and not own)
            ):
                asked.append(e)
        for a in answers:
            if a["wrapper"] != source or not any(match(a, e) for e in asked):
                continue
            a = dict(a, queue_id=None)
            for k in (*kinds, "queue_id"):
                if a[k] is None:
                    continue
                for e in asked:
                    if e[k] == a[k]:
                        for other in (*kinds, "queue_id"):
                            if a[other] is None and e[other] is not None:
                                a[other] = e[other]
            if a["abstract"] is not None and len(a["abstract"]) < min_length:
                a["abstract"] = None
            if a["abstract"] is not None and a["queue_id"] is not None:
                found.add(a["queue_id"])
            landed.append(a)
    for i, e in queue.items():
        if i in found:
            e["sources"] = [s for s in e["sources"] if s[1] == 1]
        else:
            e["sources"] = [s for s in e["sources"] if s[0] != head.get(i)]
    return {i: list(map(tuple, e["sources"])) for i, e in queue.items() if e["sources"]}, sorted(
        (a["record_id"], a["doi"] or "", a["queue_id"], a["abstract"]) for a in landed
    )


def test_turn_against_simulation(spark):
    import random

    rng = random.Random(3)
    names = ("SCOPUS", "PUBMED", "WOS")

    def ids(i):
        return dict(
            doi=rng.choice([None, "pending", f"d{i % 9}"]),
            openalex_id=rng.choice([None, f"W{i % 11}"]),
            pubmed_id=rng.choice([None, f"{i % 7}"]),
        )

    queue = [
        dict(queue_id=i, **ids(i), on_conflict=rng.randint(1, 4), time_created=START + timedelta(hours=rng.randint(0, 9)),
             sources=rng.choice([None, [("SCOPUS", 2), ("WOS", 1)], [("PUBMED", 2)], [("WOS", 1), ("PUBMED", 2)]]))
        for i in range(20)
    ]
    def rows(start, n):
        return [
            dict(record_id=start + i, wrapper=rng.choice(names), **ids(i), title="t",
                 abstract=rng.choice([None, "short", f"an abstract that is long enough {i}"]),
                 raw=rng.choice([None, "{}"]), time_created=START)
            for i in range(n)
        ]

    cache, answers = rows(0, 15), rows(100, 25)
    kept = [c.split()[0] for c in QUEUE.replace(q.SOURCES_TYPE, "x").split(", ")]
    cols = [c.split()[0] for c in CACHE.split(", ")]
    frame = spark.createDataFrame([tuple(e[c] for c in kept) for e in queue], QUEUE)
    cached = spark.createDataFrame([tuple(r[c] for c in cols) for r in cache], CACHE)
    offered = spark.createDataFrame([tuple(r[c] for c in cols) for r in answers], CACHE)
    left, landed = q.work_turn(frame, cached, offered)
    expected_left, expected_landed = simulate(queue, cache, answers)
    assert {r["queue_id"]: [tuple(s) for s in r["sources"]] for r in left.collect()} == expected_left
    found = sorted((r["record_id"], r["doi"] or "", r["queue_id"], r["abstract"]) for r in landed.collect())
    assert found == expected_landed


def test_turns_never_grow_a_list(spark, sf_dir):
    queue = fx.queue(spark, sf_dir)
    before = {r["queue_id"]: r["n"] for r in q.default_sources(queue).select("queue_id", F.size("sources").alias("n")).collect()}
    left, _ = q.work_turn(queue, fx.request(spark, sf_dir), responses(spark, sf_dir))
    after = {r["queue_id"]: r["n"] for r in left.select("queue_id", F.size("sources").alias("n")).collect()}
    assert set(after) <= set(before)
    assert all(0 < n <= before[i] for i, n in after.items())
    assert sum(after.values()) < sum(before.values())


def test_presence_agrees_with_counts(spark, sf_dir):
    entries, request = q.default_sources(fx.queue(spark, sf_dir)), fx.request(spark, sf_dir)
    counted = {r["queue_id"]: r for r in q.with_counts(entries, request).withColumn("ok", q.is_eligible()).collect()}
    present = q.with_presence(entries, request).withColumn("ok", q.is_eligible(counted=False)).collect()
    assert len(present) == len(counted)
    for r in present:
        c = counted[r["queue_id"]]
        assert r["has_abstract"] == (c["num_has_abstract"] > 0) and r["has_source_raw"] == (c["num_has_source_raw"] > 0)
        assert r["has_source_request"] == (c["num_has_source_request"] > 0) and r["ok"] == c["ok"]


def test_broken_rounds_are_resumed(spark, sf_dir, tmp_path):
    queue, request, answers = fx.queue(spark, sf_dir), fx.request(spark, sf_dir), responses(spark, sf_dir)

    def result(root, done):
        left = writers.read_version(spark, f"{root}/queue", done).select("queue_id", q.format_sources(F.col("sources")).alias("s"))
        landed = spark.read.parquet(f"{root}/landed").select("batch", "record_id", "queue_id", "abstract")
        return sorted(map(str, left.collect())), sorted(map(str, landed.collect()))

    whole = str(tmp_path / "whole")
    done = jobs.work_rounds(spark, whole, queue, request, lambda asked: answers, rounds=10)
    assert 3 <= done < 10
    calls = []

    def breaks(asked):
        calls.append(asked.count())
        if len(calls) == 3:
            raise ConnectionError("the third round fails")
        return answers

    broken = str(tmp_path / "broken")
    with pytest.raises(ConnectionError):
        jobs.work_rounds(spark, broken, queue, request, breaks, rounds=10)
    assert writers.latest_version(spark, f"{broken}/queue") == 2
    # a round that had written its rows but not its queue is done again
    writers.append_batch(spark.createDataFrame([(1, "WOS")], "record_id bigint, wrapper string"), f"{broken}/landed", 3)
    assert jobs.work_rounds(spark, broken, queue.limit(0), request, lambda asked: answers, rounds=10) == done
    assert result(broken, done) == result(whole, done)
    assert jobs.work_rounds(spark, broken, queue, request, breaks, rounds=10) == done and len(calls) == 3
    bounded = str(tmp_path / "bounded")
    assert jobs.work_rounds(spark, bounded, queue, request, lambda asked: answers, rounds=2) == 2
    assert jobs.work_rounds(spark, str(tmp_path / "late"), queue, request, breaks, rounds=5, until=datetime(2020, 1, 1)) == 0


def test_answers_of_others_are_not_shuffled(spark, sf_dir, monkeypatch):
    seen = []
    land = q.land
    monkeypatch.setattr(q, "land", lambda answers, *more, **options: seen.append(answers) or land(answers, *more, **options))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        q.work_turn(fx.queue(spark, sf_dir), fx.request(spark, sf_dir), responses(spark, sf_dir))
        plan = seen[0]._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        few = sorted(r["record_id"] for r in seen[0].collect())
        # more keys than are sent: the same rows by a shuffle
        monkeypatch.setattr("vellum.operators.joins.SENT_KEYS", 3)
        q.work_turn(fx.queue(spark, sf_dir), fx.request(spark, sf_dir), responses(spark, sf_dir))
        assert "SortMergeJoin" in seen[1]._jdf.queryExecution().executedPlan().toString()
        assert few and sorted(r["record_id"] for r in seen[1].collect()) == few
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
