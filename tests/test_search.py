"""Stored indexes, stems, phrases and marked words."""

import pytest
from pyspark.sql import functions as F

from vellum.functions.text import highlight, light_stem
from vellum.operators import search
from vellum.operators.search import And, Phrase, Term
from vellum.operators.textindex import TextIndex
from vellum.plans import searching
from vellum.session import scratch_path

TEXTS = [(1, "running dogs and cats"), (2, "a dog runs, the classes end"), (3, "alpha beta gamma"), (4, "alpha beta"), (5, None)]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "id int, text string")


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def stored(spark, postings):
    path = scratch_path(spark, "index")
    search.write_index(postings, path)
    return spark.read.parquet(path)


def test_an_index_of_stems_is_searched_by_words(spark, texts):
    index = stored(spark, search.build_postings(texts, "id", "text", stemmed=True))
    assert ids(search.search(index, Term("dogs", stemmed=True))) == [1, 2]
    assert ids(search.search(index, Term("running", stemmed=True))) == [1, 2]
    assert ids(search.search(index, And((Term("class", stemmed=True), Term("ends", stemmed=True))))) == [2]
    assert ids(search.search(index, Term("do*", stemmed=True))) == [1, 2]


def test_stems(spark):
    words = {"running": "run", "runs": "run", "classes": "class", "studies": "studi", "added": "ad", "add": "add", "ring": "ring", "gas": "ga"}
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", light_stem(F.col("w")).alias("s")).collect()
    assert {r["w"]: r["s"] for r in rows} == words


def test_a_phrase_needs_all_its_gaps(spark, texts):
    index = search.build_postings(texts, "id", "text")
    words = (Term("alpha"), Term("beta"), Term("gamma"))
    assert ids(search.search(index, Phrase(words))) == [3]
    assert ids(search.search(index, Phrase(words, (1, 1)))) == [3]
    with pytest.raises(ValueError):
        Phrase(words, (1,))


@pytest.mark.parametrize("name", ["txt_boolean", "txt_phrase", "txt_near", "txt_rank_topk", "txt_stemmed", "txt_hits_per_year"])
def test_a_search_filters_terms_at_the_scan_of_the_index(spark, sf_dir, name):
    plan = getattr(searching, name)(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "term" in line]
    assert scans and all("PushedFilters: [" in line and "term," in line.split("PushedFilters: [")[1] for line in scans)
    assert "regexp_extract_all" not in plan


@pytest.mark.parametrize(
    ("terms", "text", "marked"),
    [
        (["a.b"], "axb a.b", "axb <b>a.b</b>"),
        (["c++", "c"], "c++ c d", "<b>c++</b> <b>c</b> d"),
        (["the", "then"], "The then other", "<b>The</b> <b>then</b> other"),
        (["(x"], "f(x) (x", "f(x) <b>(x</b>"),
    ],
)
def test_marked_words(spark, terms, text, marked):
    assert spark.range(1).select(highlight(F.lit(text), terms)).first()[0] == marked


def test_markers_are_taken_as_they_are(spark):
    assert spark.range(1).select(highlight(F.lit("a b"), ["a"], "$1\\", "$")).first()[0] == "$1\\a$ b"


def test_a_backslash_in_a_wildcard(spark):
    index = spark.createDataFrame([(1, "a\\b", [0]), (2, "axb", [0])], "doc_id int, term string, positions array<int>")
    assert ids(search.search(index, Term("a\\*"))) == [1]


def watched(seen):
    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return count


def test_storing_an_index_tokenizes_each_text_once(spark):
    seen = spark.sparkContext.accumulator(0)
    texts = spark.createDataFrame([(i, f"the w{i} The") for i in range(50)], "id bigint, text string").mapInArrow(watched(seen), "id bigint, text string")
    index = stored(spark, search.build_postings(texts, "id", "text", stop_words=()))
    assert seen.value == 50
    assert sorted(tuple(r) for r in index.where("doc_id = 7").collect()) == [(7, "the", [0, 2]), (7, "w7", [1])]


def test_adding_to_a_text_index_tokenizes_each_text_once(spark):
    seen = spark.sparkContext.accumulator(0)
    texts = spark.createDataFrame([(i, f"the w{i}") for i in range(50)], "id bigint, text string").mapInArrow(watched(seen), "id bigint, text string")
    index = TextIndex(spark, scratch_path(spark, "once"), buckets=4)
    index.add(texts, "id", "text")
    assert seen.value == 100  # once for the postings, once for the list of documents
    assert len(ids(index.search(Term("the")))) == 50


def test_words_of_a_row_are_grouped_with_their_places(spark):
    texts = spark.createDataFrame([("a", "x y X", ), ("a", "y"), (None, "y z"), ("b", None), ("c", "")], "id string, text string")
    found = search.build_postings(texts, "id", "text", stop_words=())
    assert dict(found.dtypes) == {"doc_id": "string", "term": "string", "positions": "array<int>"}
    expected = [("a", "x", [0, 2]), ("a", "y", [0]), ("a", "y", [1]), (None, "y", [0]), (None, "z", [1])]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
