"""The segmented text index: stems, wildcards, substrings, updates, and ranking by covers."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from vellum.functions.stemming import english_stem
from vellum.operators import search
from vellum.operators.search import And, AnyOf, Near, Not, Or, Phrase, Term
from vellum.operators.textindex import TextIndex, rank_covers, required_trigrams

# Words and stems as published with the algorithm.
PUBLISHED = """
    consign consign, consigned consign, consigning consign, consignment consign, consist consist, consisted consist,
    consistency consist, consistent consist, consistently consist, consisting consist, consists consist,
    consolation consol, consolations consol, consolatory consolatori, console consol, consoled consol,
    consoles consol, consolidate consolid, consolidated consolid, consolidating consolid, consoling consol,
    consolingly consol, consols consol, consonant conson, consort consort, consorted consort, consorting consort,
    conspicuous conspicu, conspicuously conspicu, conspiracy conspiraci, conspirator conspir, conspirators conspir,
    conspire conspir, conspired conspir, conspiring conspir, constable constabl, constables constabl,
    constance constanc, constancy constanc, constant constant, knack knack, knackeries knackeri, knacks knack,
    knag knag, knave knave, knaves knave, knavish knavish, kneaded knead, kneading knead, knee knee, kneel kneel,
    kneeled kneel, kneeling kneel, kneels kneel, knees knee, knell knell, knelt knelt, knew knew, knick knick,
    knif knif, knife knife, knight knight, knightly knight, knights knight, knit knit, knits knit, knitted knit,
    knitting knit, knives knive, knob knob, knobs knob, knock knock, knocked knock, knocker knocker,
    knockers knocker, knocking knock, knocks knock, knopp knopp, knot knot, knots knot, generate generat,
    generally general, generic generic, generously generous, running run, hopping hop, hoping hope, ties tie,
    cries cri, gas gas, this this, gaps gap, kiwis kiwi, happy happi, enjoy enjoy, by by, say say, skies sky,
    dying die, relational relat, rational ration, proceed proceed, inning inning, luxuriated luxuri, bled bled,
    agreed agre, feed feed, national nation, hopefulness hope, communism communism, yellow yellow, youth youth,
    controlling control, roll roll, adoption adopt
"""


def test_published_stems(spark):
    pairs = [tuple(p.split()) for p in PUBLISHED.replace("\n", " ").split(",")]
    rows = spark.createDataFrame(pairs, "word string, stem string").withColumn("found", english_stem(F.col("word"))).collect()
    assert len(rows) > 100 and [tuple(r) for r in rows if r["stem"] != r["found"]] == []


def ids(df):
    return sorted(r[0] for r in df.collect())


TEXTS = [
    (1, "Ischemic and ischaemic strokes, ischemic"), (2, "Climate change; climates changed"), (3, "the climax of a story"),
    (4, "gamification-based (gamify) game"), (5, None), (6, ""), (7, "a" * 300 + "xyz"), (8, "Ünïcode straße ΟΔΟΣ"), (9, "100% of it_ems \\ a*b"),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "id bigint, text string")


@pytest.fixture(scope="module")
def index(spark, texts, tmp_path_factory):
    built = TextIndex(spark, str(tmp_path_factory.mktemp("index")), buckets=8)
    built.add(texts, "id", "text")
    return built


@pytest.mark.parametrize(
    ("tree", "hits"),
    [
        (Term("isch*emic"), [1]), (Term("climat*"), [2]), (Term("clima*"), [2, 3]), (Term("*ory"), [3]), (Term("*a*"), [1, 2, 3, 4, 7, 8, 9]),
        (Term("gam*"), [4]), (Phrase((Term("clim*"), Term("chang*"))), [2]), (And((Term("the"), Not(Term("change")))), [3]),
        (Term("nothing*here"), []), (Or((Term("game"), AnyOf((Term("story"), Term("a"))))), [3, 4, 9]), (Term("strokes", stemmed=True), [1]),
        (Term("changing", stemmed=True), [2]), (Phrase((Term("climate", stemmed=True), Term("changes", stemmed=True))), [2]),
    ],
)
def test_searches(index, tree, hits):
    assert ids(index.search(tree)) == hits


def test_a_search_without_its_words_needs_the_documents(index, texts):
    documents = texts.select(F.col("id").alias("doc_id"))
    assert ids(index.search(Not(Term("the")), documents)) == [1, 2, 4, 5, 6, 7, 8, 9]
    with pytest.raises(ValueError):
        index.search(Not(Term("the")))


@pytest.mark.parametrize(
    "wanted", ["hemic an", "change; cl", "Climate", "imat", "-based (", "ax", "aaaxyz", "a" * 200, "%", "it_e", "straß", "ΟΔ", "Σ", " ", "*", "ge", "emic"]
)
def test_substrings(index, texts, wanted):
    expected = [i for i, t in TEXTS if t and wanted in t]
    assert ids(index.substring(texts, "id", "text", wanted).select("id")) == expected


def test_only_buckets_of_the_terms_are_opened(index, texts):
    files = index._live(index._entries(), {1, 2}).inputFiles()
    assert files and all("_bucket=1/" in f or "_bucket=2/" in f for f in files)
    plan = index.search(Term("climat*"))
    buckets = {f.rpartition("/")[0].rpartition("_bucket=")[2] for f in plan.inputFiles() if "_bucket=" in f}
    assert len(buckets) <= 2


def test_required_trigrams():
    assert required_trigrams("on*er") == ["^on", "er$"] and required_trigrams("a*") == [] and required_trigrams("*tion*") == ["ion", "tio"]


def postings(df):
    return sorted((r["doc_id"], r["term"], tuple(r["positions"])) for r in df.collect())


def test_updates_and_merges_equal_a_fresh_build(spark, tmp_path):
    rng = random.Random(2)
    words = "alpha beta gamma delta omega".split()
    state = {}
    index = TextIndex(spark, str(tmp_path / "grown"), buckets=4, fan=3)
    for round in range(7):
        changed = {i: " ".join(rng.choices(words, k=rng.randint(0, 6))) for i in rng.sample(range(20), 4)}
        index.add(spark.createDataFrame(list(changed.items()), "id bigint, text string"), "id", "text")
        state.update(changed)
        if round == 3:
            index.remove(spark.createDataFrame([(1,), (2,), (77,)], "id bigint"), "id")
            state = {i: t for i, t in state.items() if i not in (1, 2)}
        fresh = search.build_postings(spark.createDataFrame([*state.items(), (99, None)], "id bigint, text string"), "id", "text", stop_words=())
        assert postings(index.postings()) == postings(fresh)
        assert len(index._entries()) <= 5
    before = ids(index.search(Term("al*")))
    index.merge()
    assert len(index._entries()) == 1 and postings(index.postings()) == postings(fresh) and ids(index.search(Term("al*"))) == before
    index.forget(keep=1)
    again = TextIndex(spark, str(tmp_path / "grown"))
    assert again.buckets == 4 and postings(again.postings()) == postings(fresh)
    counted = {r["term"]: r["doc_freq"] for r in again.dictionary().collect()}
    assert counted == {w: n for w in words if (n := sum(w in t.split() for t in state.values()))}


def test_an_empty_index(spark, texts, tmp_path):
    index = TextIndex(spark, str(tmp_path))
    assert index.postings().count() == 0 and ids(index.search(Term("a*"))) == []


# -- covers


def holds(tree, words, lo, hi):
    """Whether a tree without negations holds for the words lo .. hi."""
    inside = words[lo : hi + 1]
    if isinstance(tree, Term):
        return tree.text in inside
    if isinstance(tree, AnyOf):
        return any(t.text in inside for t in tree.words)
    if isinstance(tree, Phrase):
        gaps = [0, *itertools.accumulate(tree.gaps or (1,) * (len(tree.words) - 1))]
        return any(all(i + g < len(inside) and holds(w, inside, i + g, i + g) for w, g in zip(tree.words, gaps, strict=True)) for i in range(len(inside)))
    if isinstance(tree, Near):
        return any(
            i != j and abs(i - j) <= tree.distance and holds(tree.left, inside, i, i) and holds(tree.right, inside, j, j)
            for i in range(len(inside)) for j in range(len(inside))
        )
    found = [holds(p, words, lo, hi) for p in tree.parts if not isinstance(p, Not)]
    return all(found) if isinstance(tree, And) else any(found)


def covers(tree, words):
    n = len(words)
    good = {(i, j) for i in range(n) for j in range(i, n) if holds(tree, words, i, j)}
    return [(i, j) for i, j in good if (i + 1, j) not in good and (i, j - 1) not in good]


A, B, C, D = (Term(w) for w in "abcd")
TREES = [
    And((A, B, C, D)), And((Or((A, B)), C, Or((Phrase((B, D)), Near(A, D, 2))))), Or((And((A, B)), And((C, D)))), Phrase((A, AnyOf((B, C)), D), (1, 2)),
    And((A, Near(B, C, 3), Not(Term("z")))), Near(A, A, 2), A,
]


@pytest.mark.parametrize("tree", TREES)
def test_covers_against_all_ranges(spark, tmp_path, tree):
    rng = random.Random(8)
    docs = {i: [rng.choice("abcdxyyzz"[: rng.choice([5, 9])]) for _ in range(rng.randint(0, 16))] for i in range(25)}
    index = TextIndex(spark, str(tmp_path), buckets=2)
    index.add(spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "id bigint, text string"), "id", "text")
    negated = any(isinstance(p, Not) for p in getattr(tree, "parts", ()))
    expected = {}
    for i, words in docs.items():
        found = covers(tree, words)
        if found and not (negated and "z" in words):
            expected[i] = (len(found), round(sum(1 / (j - k + 1) for k, j in found), 6))
    rows = {r["doc_id"]: (r["n_covers"], r["score"]) for r in rank_covers(index, tree, 100).collect()}
    assert rows.keys() == expected.keys() and all(rows[i] == pytest.approx(expected[i]) for i in rows) and expected
    best = [r["doc_id"] for r in rank_covers(index, tree, 3).collect()]
    assert best == sorted(expected, key=lambda i: (-expected[i][1], i))[:3]


def test_nothing_to_rank_by(index):
    with pytest.raises(ValueError):
        rank_covers(index, Not(A), 5)
