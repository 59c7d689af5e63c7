import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm.samples import awkward_texts, collected, documents, prose
from pyspark.sql import functions as F

from vellum.llm import language, quality
from vellum.llm.common import byte_windows, fold, read_table, slices

SF = "/root/testdata/sf0.01"


def numeric_gradients(model, loss, keys, step=1e-3):
    rng = np.random.default_rng(0)
    for key in keys:
        p = model.p[key]
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in p.shape)
            old = p[at]
            p[at] = old + step
            up = loss()
            p[at] = old - step
            down = loss()
            p[at] = old
            yield key, at, (up - down) / (2 * step)


def as_double(model):
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    return model


def test_network_gradients():
    config = language.LanguageConfig(window=20, embedding=3, filters=4)
    model = as_double(language.ByteCnn(["a", "b", "c"], config))
    rng = np.random.default_rng(1)
    windows, target = rng.integers(97, 110, (8, 20 + model.pad)).astype(np.uint8), rng.integers(0, 3, 8)

    def loss():
        logits = model.pooled(windows)[1] @ model.p["U"] + model.p["c"]
        logits = logits - logits.max(axis=1, keepdims=True)
        return -(logits - np.log(np.exp(logits).sum(axis=1, keepdims=True)))[np.arange(8), target].mean()

    own = model.gradients(windows, target)
    for key, at, slope in numeric_gradients(model, loss, ("U", "c", "b", "E"), 1e-5):
        assert own[key][at] == pytest.approx(slope, abs=1e-4)


def test_attention_gradients():
    model = as_double(quality.GatedMil(quality.QualityConfig(hidden=5, attention=3)))
    rng = np.random.default_rng(2)
    counts, target = np.array([1, 4, 2, 3]), np.array([0.0, 1, 1, 0])
    f = rng.normal(size=(10, 256 + quality.PAIRS + quality.SHAPE))

    def loss():
        y = model.forward(f, counts)["y"]
        return -(target * np.log(y) + (1 - target) * np.log(1 - y)).mean()

    own = model.gradients(f, counts, target)
    for key, at, slope in numeric_gradients(model, loss, model.p, 1e-5):
        assert own[key][at] == pytest.approx(slope, abs=1e-4)
    weights = model.forward(f, counts)["a"]
    assert np.add.reduceat(weights, [0, 1, 5, 7]) == pytest.approx(np.ones(4))


def test_windows_hold_every_byte():
    texts = [b"", b"abc", b"abcd", b"x" * 9]
    windows, used, counts = byte_windows(texts, 4, 2)
    assert counts.tolist() == [1, 1, 1, 3] and windows.shape == (6, 6)
    rows = iter(zip(windows, used, strict=True))
    assert [b"".join(w[:u].tobytes() for w, u in (next(rows) for _ in range(n))) for n in counts.tolist()] == texts
    assert list(slices([5, 1, 1, 9, 1], 3)) == [(0, 1), (1, 3), (3, 4), (4, 5)]


def test_language_of_held_out_documents(spark):
    docs = read_table(spark, SF, "documents")
    model = language.fit_language(docs, where=fold("doc_id", 4) != 2)
    found = language.identify_language(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(fold("doc_id", 4) == 2)
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.97


def test_quality_of_held_out_documents(spark):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    model = quality.fit_quality(docs, labels, where=fold("doc_id", 4) != 2)
    found = quality.score_quality(docs, model).join(labels, "doc_id").filter(fold("doc_id", 4) == 2)
    right, n = found.agg(F.avg(((F.col("score") >= 0.7) == (F.col("quality") == 1)).cast("int")), F.count("*")).first()
    assert n > 60 and right > 0.93


def test_scores_use_whole_texts(spark):
    docs = read_table(spark, SF, "documents")
    model = language.fit_language(docs)
    german, french = (docs.filter(f"lang = '{x}' AND n_chars > 2000").orderBy("doc_id").first().text[:2000] for x in ("de", "fr"))
    assert model.predict([german + french * 5, german * 5 + french])[0] == ["fr", "de"]


def test_awkward_rows(spark):
    docs = documents(spark)
    model = language.fit_language(docs, where=fold("doc_id", 4) != 2)
    found = {r.doc_id: r for r in language.identify_language(docs, model).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        letters = any(c.isalpha() for c in text or "")
        assert (found[doc_id].lang_pred == language.UNKNOWN) == (not letters)
        assert 0 <= found[doc_id].score <= 1 and (letters or found[doc_id].score == 0)
    labels = spark.createDataFrame([(3 * i, i % 2, "x") for i in range(30)] + [(6, 1, "x"), (None, 1, "x"), (9, None, "x")], "doc_id long, quality int, label string")
    scores = collected(quality.score_quality(docs, quality.fit_quality(docs, labels)))
    assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)
    empty = {r.score for r in scores if r.doc_id in (0, 3)}
    assert len(empty) == 1


def test_without_labels(spark):
    docs = documents(spark)
    none = language.fit_language(docs, where=F.lit(False))
    assert none is None and {r.lang_pred for r in language.identify_language(docs, none).collect()} == {language.UNKNOWN}
    labels = spark.createDataFrame([(3, 1), (6, 1)], "doc_id long, quality int")
    assert {r.score for r in quality.score_quality(docs, quality.fit_quality(docs, labels)).collect()} == {1.0}
    assert {r.score for r in quality.score_quality(docs, quality.fit_quality(docs, labels.limit(0))).collect()} == {0.5}
    nothing = documents(spark, [])
    assert language.identify_language(nothing, language.fit_language(nothing)).collect() == []
    assert quality.score_quality(nothing, quality.fit_quality(nothing, labels)).collect() == []


def test_the_sample_is_bounded_and_holds_whole_texts(spark):
    docs = documents(spark, [prose(i, 20 + 60 * (i % 3)) for i in range(200)])
    labelled = docs.select(F.col("doc_id").alias("id"), "text", F.lit("en").alias("label"))
    windows, target, names = language.training_windows(labelled, language.LanguageConfig(sample=20))
    held = {t.encode(): -(-len(t.encode()) // 256) for t in (r.text for r in docs.select("text").collect())}
    assert names == ["en"] and len(windows) == len(target)
    # whole texts, one after another, and no more of them than the bound
    found, at = 0, 0
    while at < len(windows):
        text = next(t for t, n in held.items() if b"".join(w[:256].tobytes() for w in windows[at : at + n]).rstrip(b"\0") == t)
        at, found = at + held[text], found + 1
    assert 0 < found <= 20


def plain_language(model, text):
    """Score of every label, window by window and position by position."""
    raw, total = text.encode(), np.zeros(len(model.labels))
    for at in range(0, max(1, len(raw)), model.config.window):
        part = raw[at : at + model.config.window]
        padded = part.ljust(model.config.window + model.pad, b"\0")
        best = np.full(model.p["W"].shape[1], -np.inf)
        for i in range(model.config.window):
            seen = np.concatenate([model.p["E"][b] for b in padded[i : i + model.pad + 1]]).astype(np.float64)
            best = np.maximum(best, seen @ model.p["W"])
        logits = np.maximum(best + model.p["b"], 0) @ model.p["U"] + model.p["c"]
        total += len(part) * (logits - np.log(np.exp(logits - logits.max()).sum()) - logits.max())
    q = np.exp(total / len(raw) - (total / len(raw)).max())
    return q / q.sum()


def test_language_equals_a_plain_forward_pass():
    model = language.ByteCnn(["a", "b", "c"], language.LanguageConfig(window=40))
    texts = [prose(1, 3), prose(2, 40), "é漢字 and more " * 9]
    labels, scores = model.predict(texts)
    for text, label, score in zip(texts, labels, scores, strict=True):
        q = plain_language(model, text)
        assert label == model.labels[int(q.argmax())] and score == pytest.approx(q.max(), abs=1e-4)


def plain_quality(model, text):
    """Probability, passage by passage."""
    raw, p, width = text.encode(), model.p, model.config.passage
    states, weights = [], []
    for at in range(0, max(1, len(raw)), width):
        part = raw[at : at + width]
        singles, pairs = np.zeros(256), np.zeros(quality.PAIRS)
        for x in part:
            singles[x] += 1
        for x, y in zip(part, part[1:], strict=False):
            pairs[(x * 40503 + y * 30011 >> 3) % quality.PAIRS] += 1
        f = np.concatenate([np.sqrt(np.concatenate([singles, pairs]) / max(1, len(part))), quality.shape(part)])
        h = np.tanh(f @ p["W"] + p["b"])
        states.append(h)
        weights.append(np.exp((np.tanh(h @ p["V"]) / (1 + np.exp(-(h @ p["U"])))) @ p["w"]))
    z = sum(w * h for w, h in zip(weights, states, strict=True)) / sum(weights)
    return float(1 / (1 + np.exp(-(z @ p["c"] + p["d"])))[0])


def test_quality_equals_a_plain_forward_pass():
    model = quality.GatedMil(quality.QualityConfig(passage=60))
    model.trained = True
    texts = ["", prose(1, 3), prose(2, 90), "é漢字 and more " * 9]
    assert model.score(texts) == pytest.approx([plain_quality(model, t) for t in texts], abs=1e-4)


def test_fold():
    assert zlib.crc32(b"17") % 4 == 2 or zlib.crc32(b"17") % 4 in (0, 1, 3)
    assert pa.array(awkward_texts()).null_count == 2
