"""Updates, deletions, sources, payloads, samples and search."""

import gzip
import random
import tempfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from vellum.operators import flatten, joins, payloads, reports, search, upsert
from vellum.operators.search import And, AnyOf, Near, Not, Or, Phrase, Term
from vellum.plans.nested import nested_works
from vellum.sources import corpora, snapshot, writers
from vellum.sources.keyed import KeyedLog
from vellum.streaming import incremental

NOW = datetime(2024, 6, 1)
INDEX = (
    "id string, doi string, title string, abstract string, title_abstract string, abstract_source string, "
    "abstract_date timestamp_ntz, updated_date date"
)


@pytest.fixture
def folder():
    # kept on purpose: nothing is deleted by the tests
    return Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def index(spark):
    return spark.createDataFrame(
        [
            ("W1", "d1", "t1", "own", "t1 own", "OpenAlex", datetime(2023, 1, 1), None),
            ("W2", "d2", "t2", None, "t2 ", None, None, None),
            ("W3", "d3", None, None, None, None, None, None),
            ("W4", "d4", "t4", "bought", "t4 bought", "SCOPUS", datetime(2023, 1, 1), None),
        ],
        INDEX,
    )


def best(spark):
    return spark.createDataFrame(
        [("W1", "n1", "a1", "WOS"), ("W2", "n2", "a2", "PUBMED"), ("W9", "n9", "a9", "WOS")],
        "openalex_id string, title string, abstract string, abstract_source string",
    )


def test_fill_changes_only_what_is_missing(spark):
    filled = upsert.fill_abstracts(index(spark), best(spark), F.lit(NOW).cast("timestamp_ntz"))
    assert rows(filled, "id", "title", "abstract", "title_abstract", "abstract_source", "abstract_date") == [
        ("W1", "t1", "own", "t1 own", "OpenAlex", datetime(2023, 1, 1)),
        ("W2", "n2", "a2", "n2 a2", "PUBMED", NOW),
        ("W3", None, None, None, None, None),
        ("W4", "t4", "bought", "t4 bought", "SCOPUS", datetime(2023, 1, 1)),
    ]


def test_fill_with_force(spark):
    filled = upsert.fill_abstracts(index(spark), best(spark), F.lit(NOW).cast("timestamp_ntz"), force=True)
    assert rows(filled, "id", "abstract") == [("W1", "a1"), ("W2", "a2"), ("W3", None), ("W4", "bought")]


def test_fill_does_not_shuffle_documents_with_abstract(spark, folder):
    index(spark).write.parquet(f"{folder}/index")
    stored = spark.read.parquet(f"{folder}/index")
    plan = upsert.fill_abstracts(stored, best(spark), F.lit(NOW).cast("timestamp_ntz"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNull(abstract)" in text and "PushedFilters: [IsNotNull(abstract)" in text


def test_update_keeps_abstracts(spark):
    update = spark.createDataFrame(
        [("W1", "d1", "n1", None, None), ("W2", "d2", "n2", "new", "OpenAlex"), ("W4", "d4", "n4", None, None),
         ("W5", "d5", "n5", "first", None), ("W6", None, "n6", None, None)],
        "id string, doi string, title string, abstract string, abstract_source string",
    )
    following = upsert.apply_update(index(spark), update, F.lit(NOW).cast("timestamp_ntz"))
    assert rows(following, "id", "title", "abstract", "abstract_source", "abstract_date") == [
        ("W1", "n1", "own", "OpenAlex_old", datetime(2023, 1, 1)),
        ("W2", "n2", "new", "OpenAlex", NOW),
        ("W3", None, None, None, None),
        ("W4", "n4", "bought", "SCOPUS", datetime(2023, 1, 1)),
        ("W5", "n5", "first", "OpenAlex", NOW),
        ("W6", "n6", None, None, None),
    ]


def test_retain_old(spark):
    old = spark.createDataFrame([("W1", "o1"), ("W2", "o2"), ("W3", None), ("W9", "o9")], "openalex_id string, abstract string")
    following, cache_rows, counters = upsert.retain_old(old, index(spark), F.lit(NOW).cast("timestamp_ntz"))
    assert rows(following, "id", "abstract") == [("W1", "own"), ("W2", "o2"), ("W3", None), ("W4", "bought")]
    assert rows(cache_rows, "wrapper", "openalex_id", "abstract", "solarized") == [("OpenAlex_old", "W2", "o2", True)]
    assert tuple(counters.first()) == (4, 3, 2, 1)


def test_upsert_modes(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    new = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    assert rows(upsert.upsert(old, new, "k"), "k", "v", "w") == [(1, "a", "x"), (2, None, None), (3, "c", None)]
    assert rows(upsert.upsert(old, new, "k", "patch"), "k", "v", "w") == [(1, "a", "x"), (2, None, "y")]
    merged = upsert.upsert(old, new, "k", "coalesce")
    assert rows(merged, "k", "v", "w") == [(1, "a", "x"), (2, "b", "y"), (3, "c", None)]
    once = upsert.upsert(old, new, "k")
    assert rows(upsert.upsert(once, new, "k"), "k", "v") == rows(once, "k", "v")


def test_first_per_key_is_whole_and_ordered(spark):
    table = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 5, "z"), (None, 1, "n")], "k string, o int, v string")
    assert rows(joins.first_per_key(table, ["k"], ["o"]), "k", "o", "v") == [("a", 1, None), ("b", 5, "z"), (None, 1, "n")]
    assert rows(joins.first_per_key(table, ["k"], ["o"], last=True), "k", "o") == [("a", 2), ("b", 5), (None, 1)]


def test_left_lookup_keeps_rows_without_key(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "c")], "id int, k string")
    right = spark.createDataFrame([("a", 10), (None, 20)], "rk string, v int")
    found = joins.left_lookup(left, right, "k", "rk", ["id"])
    assert rows(found, "id", "k", "v") == [(1, "a", 10), (2, None, None), (3, None, None), (4, "c", None)]


def test_replace_entity(spark):
    tables = {
        "concepts": spark.createDataFrame([("C1", 1), ("C2", 1)], "concept_id string, level int"),
        "concepts_ancestors": spark.createDataFrame(
            [("C9", "C1"), ("C1", "C2")], "parent_concept_id string, child_concept_id string"
        ),
    }
    updates = {
        "concepts": spark.createDataFrame([("C1", 2)], "concept_id string, level int"),
        "concepts_ancestors": spark.createDataFrame([("C8", "C1")], "parent_concept_id string, child_concept_id string"),
    }
    after = upsert.replace_entity(tables, updates, "concept")
    assert rows(after["concepts"], "concept_id", "level") == [("C1", 2), ("C2", 1)]
    # the edge that only points at C1 stays
    assert rows(after["concepts_ancestors"], "parent_concept_id", "child_concept_id") == [("C1", "C2"), ("C8", "C1")]


def test_snapshot_files(spark, folder):
    lines = {
        "works/updated_date=2024-01-01/part_000.gz": ['{"id": "https://openalex.org/W1", "title": "a"}', "", "{broken"],
        "works/updated_date=2024-01-02/part_000.gz": ['{"id": "https://openalex.org/W2", "unknown": [1]}'],
        "works/updated_date=2024-01-03/part_000.gz": ['{"id": "https://openalex.org/W3", "abstract_inverted_index": {"x": [0], "y": [1]}}'],
    }
    for name, content in lines.items():
        path = folder / name
        path.parent.mkdir(parents=True)
        path.write_bytes(gzip.compress("\n".join(content).encode()))
    from vellum.sources.schemas import WORK_ABSTRACT

    def ids(**options):
        return [r[0][-2:] for r in rows(snapshot.split_corrupt(snapshot.read_snapshot(spark, str(folder), **options))[0], "id")]

    assert ids(schema=WORK_ABSTRACT) == ids() == ["W1", "W2", "W3"]
    assert ids(since="2024-01-02") == ["W2", "W3"]
    assert ids(since="2024-01-02", inclusive=False) == ["W3"]
    assert ids(skip=2) == ["W3"] and ids(skip=9) == []
    _, bad = snapshot.split_corrupt(snapshot.read_snapshot(spark, str(folder)))
    assert rows(bad, "id", snapshot.CORRUPT) == [(None, "{broken")]
    files = snapshot.snapshot_files(spark, f"{folder}/works")
    done = files.where(F.col("path").contains("2024-01-01"))
    pending, ledger = snapshot.read_pending(spark, str(folder), done, schema="id STRING")
    assert [r[0][-2:] for r in rows(pending, "id")] == ["W2", "W3"]
    nothing, _ = snapshot.read_pending(spark, str(folder), done.unionByName(ledger), schema="id STRING")
    assert nothing.count() == 0
    plan = snapshot.read_snapshot(spark, str(folder), since="2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(updated_date" in plan


def test_merge_log(spark, folder):
    base = folder / "merged_ids" / "works"
    base.mkdir(parents=True)
    for day, row in (("2024-01-01", "2024-01-01,W1,W2"), ("2024-02-01", "2024-02-01,W3,W4")):
        (base / f"{day}.csv.gz").write_bytes(gzip.compress(f"merge_date,id,merge_into_id\n{row}\n".encode()))
    assert rows(snapshot.read_merge_log(spark, str(folder)), "id") == [("W1",), ("W3",)]
    assert rows(snapshot.read_merge_log(spark, str(folder), since="2024-01-01"), "id") == [("W3",)]
    assert rows(snapshot.read_merge_log(spark, str(folder), since="2024-01-01", inclusive=True), "id") == [("W1",), ("W3",)]


def test_id_files(spark, folder):
    (folder / "ids.txt").write_text(" W2 \n\nW1\nW2\n")
    assert rows(snapshot.read_id_list(spark, str(folder / "ids.txt")), "openalex_id") == [("W1",), ("W2",)]
    (folder / "two.csv").write_text("openalex_id,doi\nW1,10.1/a\n")
    (folder / "three.csv").write_text("openalex_id,doi,pmid\nW1,10.1/a,7\n")
    columns = ("openalex_id", "doi", "pubmed_id")
    assert rows(snapshot.read_id_csv(spark, str(folder / "two.csv")), *columns) == [("W1", "10.1/a", None)]
    assert rows(snapshot.read_id_csv(spark, str(folder / "three.csv")), *columns) == [("W1", "10.1/a", "7")]


def test_csv_writer(spark, folder):
    table = spark.createDataFrame([(1, ["a", "b"]), (2, None)], "k int, v array<string>")
    writers.write_tables({"t": table}, str(folder), form="csv")
    assert rows(spark.read.option("header", "true").csv(f"{folder}/t"), "k", "v") == [("1", "{a,b}"), ("2", None)]


def test_versions(spark, folder):
    root = f"{folder}/table"
    assert writers.read_latest(spark, root) is None
    writers.write_version(spark.range(1), root, 1)
    writers.write_version(spark.range(3), root, 2)
    assert writers.latest_version(spark, root) == 2
    assert writers.read_latest(spark, root).count() == 3


def test_tldr_and_authors_tables(spark):
    lines = spark.createDataFrame(
        [('{"corpusid": 1, "model": "m", "text": "s"}',), ('{"authorid": 2, "hindex": "x", "aliases": ["a"]}',)], "value string"
    )
    assert rows(corpora.json_to_table(lines, "s2.tldrs"), "corpus_id", "summary")[0] == ("1", "s")
    authors = rows(corpora.json_to_table(lines, "s2.authors"), "author_id", "hindex", "aliases")
    assert authors[0] == ("2", None, '["a"]')


def test_pubmed_payload(spark):
    xml = (
        "<PubmedArticle><PMID>7</PMID><PMID>8</PMID><ArticleTitle>A <i>b</i> c</ArticleTitle>"
        "<Abstract><AbstractText>one</AbstractText><AbstractText>two</AbstractText></Abstract>"
        '<ArticleIdList><ArticleId IdType="pii">x</ArticleId><ArticleId IdType="doi">10.1/a</ArticleId></ArticleIdList>'
        "</PubmedArticle>"
    )
    bare = "<PubmedArticle><PMID>9</PMID></PubmedArticle>"
    unified = payloads.unify(spark.createDataFrame([(xml,), (bare,)], "raw string"), "pubmed")
    assert rows(unified, "wrapper", "title", "abstract", "doi", "pubmed_id") == [
        ("PUBMED", "A  b  c", "one\n\ntwo", "10.1/a", "7"), ("PUBMED", None, None, None, "9"),
    ]


def test_own_adapter(spark):
    payloads.register_adapter("mine", lambda df: payloads._unified(df, title=F.upper("raw")))
    try:
        unified = payloads.unify(spark.createDataFrame([("x",)], "raw string"), "mine")
        assert rows(unified, "wrapper", "title") == [("MINE", "X")]
    finally:
        payloads.ADAPTERS.pop("MINE")


def test_price_of_a_list_is_unknown(spark):
    prices = spark.createDataFrame([('{"value_usd": 5}',), ('[{"value_usd": 5}]',), (None,)], "p string")
    assert [r[0] for r in prices.select(flatten.price_usd(F.col("p"))).collect()] == [5, None, None]


def test_sample_is_the_same_however_partitioned(spark):
    ids = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    first = rows(reports.seeded_sample(ids, "id", 20, 7), "id")
    assert first == rows(reports.seeded_sample(ids.repartition(13), "id", 20, 7), "id")
    assert first != rows(reports.seeded_sample(ids, "id", 20, 8), "id")
    assert len(rows(reports.seeded_sample(ids.union(ids), "id", 2000, 7), "id")) == 1000


WORDS = ("carbon", "co2", "capture", "captures", "storage", "the")


def holds(expr, words):
    places = {}
    for i, w in enumerate(words):
        places.setdefault(w, []).append(i)

    def at(word):
        if isinstance(word, AnyOf):
            return {p for w in word.words for p in at(w)}
        stem = word.text.rstrip("*")
        return {p for w, ps in places.items() for p in ps if (w.startswith(stem) if "*" in word.text else w == stem)}

    if isinstance(expr, (Term, AnyOf)):
        return bool(at(expr))
    if isinstance(expr, Phrase):
        reached = at(expr.words[0])
        for word, gap in zip(expr.words[1:], expr.gaps or (1,) * len(expr.words)):
            reached = {p + gap for p in reached} & at(word)
        return bool(reached)
    if isinstance(expr, Near):
        return any(0 < abs(a - b) <= expr.distance for a in at(expr.left) for b in at(expr.right))
    if isinstance(expr, Not):
        return not holds(expr.part, words)
    return (all if isinstance(expr, And) else any)(holds(p, words) for p in expr.parts)


TREES = [
    Phrase((AnyOf((Term("carbon"), Term("co2"))), Term("capture"), Term("storage")), (1, 2)),
    Near(Term("carbon"), Term("storage"), 2),
    Near(Term("co2"), Term("co2"), 1),
    And((Term("captur*"), Not(Or((Term("the"), Term("co2")))))),
    Or((Phrase((Term("the"), Term("the"))), Near(AnyOf((Term("co2"), Term("carbon"))), Term("capt*"), 3))),
    Not(Phrase((Term("carbon"), Term("storage")))),
]


@pytest.mark.parametrize("stored", [False, True])
@pytest.mark.parametrize("tree", TREES)
def test_search_against_reading_the_text(spark, tree, stored):
    rng = random.Random(11)
    texts = [[rng.choice(WORDS) for _ in range(rng.randint(0, 7))] for _ in range(80)]
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id int, text string")
    build = search.build_postings if stored else search.scan_postings
    hits = search.search(build(table, "doc_id", "text", stop_words=()), tree, table)
    assert sorted(r["doc_id"] for r in hits.collect()) == [i for i, t in enumerate(texts) if holds(tree, t)]


def test_stop_words_keep_their_place(spark):
    table = spark.createDataFrame([(1, "carbon in storage")], "doc_id int, text string")
    postings = search.build_postings(table, "doc_id", "text")
    assert rows(postings, "term", "positions") == [("carbon", [0]), ("storage", [2])]
    assert search.search(postings, Phrase((Term("carbon"), Term("storage")), (2,))).count() == 1


def test_bare_not_needs_documents(spark):
    table = spark.createDataFrame([(1, "x")], "doc_id int, text string")
    with pytest.raises(ValueError):
        search.search(search.scan_postings(table, "doc_id", "text"), Not(Term("y")))


def test_index_file_prunes_by_term(spark, folder):
    table = spark.range(200).selectExpr("id AS doc_id", "concat('w', id, ' common') AS text")
    search.write_index(search.build_postings(table, "doc_id", "text"), f"{folder}/index")
    stored = spark.read.parquet(f"{folder}/index")
    hits = search.search(stored, Term("w17"))
    assert [r["doc_id"] for r in hits.collect()] == [17]
    assert "EqualTo(term,w17)" in hits._jdf.queryExecution().executedPlan().toString()


def test_ingest_survives_a_replayed_batch(spark, folder):
    base = folder / "in" / "works" / "updated_date=2024-01-01"
    base.mkdir(parents=True)
    (base / "a.json").write_text('{"id": "1", "title": "a"}\n{"id": "1", "title": "a"}\n{bad\n')
    records = incremental.stream_snapshot(spark, f"{folder}/in", "work", "id STRING, title STRING")
    for _ in range(2):
        incremental.start_ingest(records, "id", f"{folder}/log", f"{folder}/cp").awaitTermination()
    log = KeyedLog(spark, f"{folder}/log", "id", "id STRING, title STRING, updated_date DATE", ("updated_date",))
    assert rows(log.read(), "id", "title") == [("1", "a")]
    # the same batch again changes nothing
    again = spark.createDataFrame([("1", "b")], "id string, title string").withColumn("updated_date", F.lit("2024-06-01").cast("date"))
    log.append(again, 0)
    assert rows(log.read(), "id", "title") == [("1", "a")]
    # later files only add to it
    later = folder / "in" / "works" / "updated_date=2024-01-02"
    later.mkdir(parents=True)
    (later / "b.json").write_text('{"id": "2", "title": "c"}\n')
    incremental.start_ingest(records, "id", f"{folder}/log", f"{folder}/cp").awaitTermination()
    assert rows(log.read(), "id", "title") == [("1", "a"), ("2", "c")]


def test_smallest_draws_against_sorting(spark):
    rng = random.Random(4)
    draws = [f"{rng.choice([0, 1, rng.getrandbits(32)]):08x}" for _ in range(400)]
    rows_ = spark.createDataFrame([(i, d) for i, d in enumerate(draws)], "id int, d string")
    expected = sorted((d, i) for i, d in enumerate(draws))
    for n in (0, 1, 5, 133, 134, 399, 400, 1000):
        found = reports.smallest_draws(rows_, "d", "id", n)
        assert sorted((r["d"], r["id"]) for r in found.collect()) == expected[:n]
    plan = reports.smallest_draws(spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("d"), "id"), "d", "id", 2000)
    assert "TakeOrderedAndProject" not in plan._jdf.queryExecution().executedPlan().toString()


def test_nested_works_are_read_from_the_documents_themselves(spark, sf_dir):
    files = nested_works(spark, sf_dir).inputFiles()
    assert files and all(f.endswith("documents.parquet") for f in files)


def test_deleting_an_entity_computes_its_ids_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    ids = spark.createDataFrame([("W1",), ("W1",), (None,)], "id string").mapInArrow(count, "id string")
    owned = {name: spark.createDataFrame([("W1",), ("W2",), (None,)], f"{key} string") for name, key in upsert.OWNED_TABLES["work"].items()}
    for table in upsert.delete_entity(owned, ids, "work").values():
        assert sorted((r[0] for r in table.collect()), key=str) == [None, "W2"]
    assert seen.value == 3
