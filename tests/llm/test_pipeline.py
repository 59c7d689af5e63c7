import pytest
from llm.samples import collected, documents, edited, prose
from pyspark.sql import functions as F

import corpus_pipeline
from llm.test_pairs import brute_classes, slow_best_fit
from vellum.llm import language, neardup, quality, queries
from vellum.llm.common import fold, read_table, texts
from vellum.llm.packing import bits

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    labels = {r.doc_id: r.quality for r in read_table(spark, SF, "labels").collect()}
    names, kept = [], docs
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, stage(spark, kept, SF).persist()
        names.append(name)
        if name != "packing":
            assert kept.columns == docs.columns
            assert kept.join(before, docs.columns, "left_anti").count() == 0
            ids = {r.doc_id for r in kept.select("doc_id").collect()}
            clean = [d for d in ids if labels.get(d) == 1]
            assert len(clean) > 0
        if name == "quality":
            good = [d for d, q in labels.items() if q == 1]
            assert sum(d in ids for d in good) >= 0.97 * len(good)
        if name == "near_dedup":
            assert kept.select("text").distinct().count() == kept.count() < before.count()
    assert names == ["language", "quality", "near_dedup", "packing"]
    assert {r.doc_id for r in kept.collect()} == ids


def test_near_dedup_keeps_one_of_each_group(spark):
    base = [prose(i, 80) for i in range(6)]
    docs = documents(spark, [*base, *base, *[edited(t, i, 0.01) for i, t in enumerate(base)], None, "", "  "])
    kept = collected(corpus_pipeline.near_dedup(spark, docs, SF))
    assert [r.doc_id for r in kept] == [None, *[3 * i for i in range(6)], 54, 60]
    assert kept[0].asDict().keys() == set(docs.columns)


def test_a_document_without_id_stays_once(spark):
    docs = documents(spark, ["one text", "another", prose(7, 90)])
    extra = docs.filter("doc_id IS NULL")
    copy = docs.filter("doc_id = 0").withColumn("doc_id", F.lit(None).cast("long"))
    near = docs.filter("doc_id = 6").withColumn("doc_id", F.lit(None).cast("long")).withColumn("text", F.lit(edited(prose(7, 90), 1, 0.01)))
    kept = corpus_pipeline.near_dedup(spark, docs.unionByName(extra).unionByName(copy).unionByName(near).dropDuplicates(["doc_id", "text"]), SF)
    assert [(r.doc_id, r.text) for r in collected(kept)] == [(None, "a text without id"), (0, "one text"), (3, "another"), (6, prose(7, 90))]


def test_run_equals_plain_stages(spark):
    """The rows of run() against plain Python: labels text by text, every pair of texts, a linear search for bins."""
    docs = read_table(spark, SF, "documents").select("doc_id", "text", "source", "lang")
    known = fold("doc_id", 4) != 2
    rows = [tuple(r) for r in collected(docs)]
    net = language.fit_language(docs, where=known)
    rows = [r for r in rows if (x := [y[0] for y in net.predict([r[1] or ""])])[0] != "und" and x[1] >= corpus_pipeline.LANGUAGE]
    left = spark.createDataFrame(rows, docs.schema)
    model = quality.fit_quality(left, read_table(spark, SF, "labels"), where=known)
    rows = [r for r in rows if model.score([r[1] or ""])[0] >= corpus_pipeline.QUALITY]
    config = neardup.NearDupConfig()
    idf = neardup.document_frequencies(texts(spark.createDataFrame(rows, docs.schema)), config)
    leaders = {i for i, leader in brute_classes([r[:2] for r in rows], idf, config) if i == leader}
    assert 0 < len(leaders) < len(rows) < docs.count()
    pieces = []
    for doc_id, text, source, _ in rows:
        if doc_id in leaders:
            total = len((text or "").split()) + 1
            pieces += [(-min(2048, total - at), doc_id, at // 2048, source) for at in range(0, total, 2048)]
    pieces.sort()
    placed = slow_best_fit([-p[0] for p in pieces], bits([p[3] for p in pieces]), [0] * len(pieces), 2048)
    expected = [(p[1], p[2], p[2] * 2048, -p[0], b, at) for p, (b, at) in zip(pieces, placed, strict=True)]
    found = corpus_pipeline.run(spark, SF).select("doc_id", "piece", "start", "length", "bin_id", "bin_offset")
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_filters_keep_rows_as_they_are(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:2]:
        kept = stage(spark, docs, SF)
        assert kept.schema == docs.schema and kept.exceptAll(docs).count() == 0, name
    plan = corpus_pipeline.language(spark, docs, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (documents(spark), documents(spark, [])):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF).count() >= 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_cover_their_table(spark, name):
    found = queries.QUERIES[name](spark, SF)
    if name == "op12_phrases":
        assert {r.lang for r in found.select("lang").distinct().collect()} == {r.lang for r in read_table(spark, SF, "documents").select("lang").distinct().collect()}
        return
    table = {"op4_main_text": "pages", "op7_neighbours": "embeddings"}.get(name, "documents")
    rows = read_table(spark, SF, table)
    if name == "op7_neighbours":
        assert found.count() == 20 * rows.filter("vec_id % 20 = 0").count()
    else:
        key = "page_id" if table == "pages" else "doc_id"
        assert found.select(key).distinct().count() == rows.count()
        assert name == "op10_packing" or found.count() == rows.count()
    assert all(c == c.lower() for c in found.columns) and found.filter(F.col(found.columns[0]).isNull()).count() == 0
