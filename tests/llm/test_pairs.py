import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from llm.samples import awkward_texts, collected, documents, edited, prose
from pyspark.sql import functions as F

from vellum.llm import multiprobe, neardup, packing, queries, winnow
from vellum.llm.common import texts
from vellum.llm.shingles import weighted_sets, words


def brute_classes(rows, idf, config):
    """Classes by comparing every pair of texts."""
    ids, bodies = [r[0] for r in rows], [r[1] or "" for r in rows]
    doc, h, w = weighted_sets(bodies, config.words, idf)
    at = np.searchsorted(doc, np.arange(len(rows) + 1))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        sets = [(h[at[x] : at[x + 1]], w[at[x] : at[x + 1]]) for x in (i, j)]
        if bodies[i] == bodies[j] or neardup.weighted_jaccard(*sets) >= config.similarity:
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    groups = {}
    for i, x in enumerate(ids):
        groups.setdefault(root(i), []).append(x)
    least = {r: min((x for x in g if x is not None), default=None) for r, g in groups.items()}
    return sorted(((x, least[root(i)]) for i, x in enumerate(ids)), key=lambda r: (r[0] is not None, r[0] or 0))


@pytest.mark.parametrize("config", [neardup.NearDupConfig(), neardup.NearDupConfig(salt=2, block=2, bands=20, sent=0)])
def test_near_duplicates_equal_brute_force(spark, config):
    families = [prose(700 + i, 120) for i in range(6)]
    more = [edited(t, 100 * i + j, 0.03) for i, t in enumerate(families) for j in range(9)]
    shared = prose(900, 60)
    docs = documents(spark, [*awkward_texts(), *families, *more, *[shared + " " + prose(1000 + i, 60) for i in range(30)]])
    idf = neardup.document_frequencies(texts(docs), config)
    found = collected(neardup.near_duplicates(docs, config=config))
    expected = brute_classes([tuple(r) for r in collected(docs.select("doc_id", "text"))], idf, config)
    assert [tuple(r) for r in found] == expected


def test_second_pass_looks_at_different_classes_only(spark):
    rows = [(k, 4, i, r, 5.0, s) for k in (1, 2) for i, r, s in ((1, 1, [1] * 64), (2, 2, [1] * 60 + [2] * 4), (3, 1, [1] * 64), (4, 4, [9] * 64))]
    members = spark.createDataFrame(rows, "key long, n long, id long, root long, weight double, samples array<int>")
    for block in (2, 1024):
        found = neardup.mixed_members(members, neardup.NearDupConfig(block=block)).collect()
        assert {r.id for r in found} == {1, 2, 3}
        tables = neardup.mixed_members(members, neardup.NearDupConfig(block=block)).orderBy(*neardup.BLOCK, "id").toArrow()
        pairs = set()
        for group in neardup.grouped(iter(tables.to_batches()), neardup.BLOCK):
            ids = group.column("id").to_pylist()
            pairs |= {(ids[x], ids[y]) for x, rest in neardup.candidates(group, neardup.NearDupConfig()) for y in rest}
        assert pairs == {(1, 2), (2, 3)}


def test_candidates_lose_few_sufficient_pairs():
    from math import comb

    config = neardup.NearDupConfig()
    assert sum(comb(64, k) * 0.8**k * 0.2 ** (64 - k) for k in range(config.agree)) < 1e-5


def test_a_group_gives_no_more_links_than_join_its_classes(spark):
    rows = [(1, 0, 0, 0, i, i, 5.0, [1] * 64, "one two three four five six") for i in range(30)]
    kinds = "key long, i int, j int, own int, id long, root long, weight double, samples array<int>, text string"
    table = spark.createDataFrame(rows, kinds)
    config = neardup.NearDupConfig()
    links = neardup.mixed_links(table.drop("text"), table.select("id", "text"), np.ones(config.table), config).collect()
    assert len(links) == 29 and {x for r in links for x in (r.a, r.b)} == set(range(30))


def test_one_class_with_few_others_is_not_crossed(spark):
    n, config = 3000, neardup.NearDupConfig(block=32)
    rows = [(7, i, 1 if i < n else i, 5.0, [i % 3] * 64) for i in range(n + 3)]
    members = spark.createDataFrame(rows, "key long, id long, root long, weight double, samples array<int>")
    members = members.join(neardup.mixed_buckets(members), "key")
    assert [tuple(r) for r in members.select("n", "major", "others").distinct().collect()] == [(n + 3, 1, 3)]
    cut = neardup.placed(members, config)
    assert cut.count() == n + 3 * -(-(n + 3) // 32)
    met = cut.alias("x").join(cut.alias("y"), list(neardup.BLOCK)).filter("x.id >= 3000 and y.id < 3000").select("x.id", "y.id")
    assert met.distinct().count() == 3 * n


def test_texts_of_one_template_are_not_crossed(spark, monkeypatch):
    shared, config, copies = prose(900, 100), neardup.NearDupConfig(block=8), []
    own = [shared + " " + prose(1000 + i, 50) for i in range(150)]
    docs = documents(spark, [*own, *[edited(t, i, 0.015) for i, t in enumerate(own[:12])]])
    idf = neardup.document_frequencies(texts(docs), config)
    placed = neardup.placed
    monkeypatch.setattr(neardup, "placed", lambda members, config: copies.append(placed(members, config)) or copies[-1])
    found = [tuple(r) for r in collected(neardup.near_duplicates(docs, config=config))]
    assert found == brute_classes([tuple(r) for r in collected(docs.select("doc_id", "text"))], idf, config)
    assert sum(c.count() for c in copies) < 8 * docs.count()  # crossing the 16 bands' buckets takes 20 a text and more


def test_similar_texts_share_one_of_their_rarest_shingles():
    config, rng = neardup.NearDupConfig(), np.random.default_rng(3)
    frequency = rng.integers(1, 50, config.table)
    for trial in range(200):
        n = int(rng.integers(1, 60))
        h, w = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)), rng.random(n) + 0.01
        w = w[: len(h)]
        keep = rng.random(len(h)) < 0.9
        x, y = (h, w), (h[keep], (w * rng.uniform(0.9, 1.1, len(h)))[keep])
        if len(y[0]) and neardup.weighted_jaccard(x, y) >= config.similarity:
            assert set(neardup.rarest(*x, frequency, config)) & set(neardup.rarest(*y, frequency, config))


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (150, 200), (300, 301)] + [(400, 400 + i) for i in range(1, 40)]
    edges = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in edges]
    found = dict(neardup.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 150: 100, 200: 100, 300: 300, 301: 300, **{400 + i: 400 for i in range(40)}}
    assert neardup.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_samples_agree_like_the_similarity():
    config, idf = neardup.NearDupConfig(bands=64, rows=8), np.ones(1 << 18)
    sampler, text = neardup.Sampler(config), prose(5, 400)
    for share in (0.01, 0.05):
        doc, h, w = weighted_sets([text, edited(text, 1, share)], 5, idf)
        cut = np.searchsorted(doc, 1)
        x, y = (h[:cut], w[:cut]), (h[cut:], w[cut:])
        agree = (sampler.draw(*x)[0] == sampler.draw(*y)[0]).mean()
        assert abs(agree - neardup.weighted_jaccard(x, y)) < 0.08


def test_sets_drawn_together_are_drawn_alike():
    config, idf = neardup.NearDupConfig(), np.random.default_rng(2).random(1 << 18) + 1
    bodies = ["", prose(1, 300), "one", "  ", prose(2, 40), prose(3, 900), "a b c d e", ""]
    doc, h, w = weighted_sets(bodies, config.words, idf)
    at = np.searchsorted(doc, np.arange(len(bodies) + 1))
    sampler = neardup.Sampler(config)
    own = [sampler.draw(h[lo:hi], w[lo:hi]) for lo, hi in zip(at[:-1], at[1:], strict=True) if hi > lo]
    for most in (1, 500, 1 << 12):
        samples, keys = sampler.draw_all(h, w, np.diff(at), most)
        assert np.array_equal(samples, np.concatenate([x for x, _ in own])) and np.array_equal(keys.ravel(), np.concatenate([x.ravel() for _, x in own]))
    assert [len(x) for x in sampler.draw_all(h[:0], w[:0], np.zeros(3, dtype=np.int64))] == [0, 0]


def test_document_frequencies_count_texts(spark):
    bodies = ["a b a", "A", "", None, "b, b, b"]
    config = neardup.NearDupConfig()
    idf = neardup.document_frequencies(texts(spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string")), config)
    hashes, _ = words(["a b z"])
    assert np.allclose(idf[neardup.buckets(hashes, config.table)], np.log(6 / np.array([3, 3, 1])) + 1)


def test_word_lengths_equal_the_pattern(spark):
    bodies = ["a b", None, "", " ", "é x  y", "\x0b\fz\r\n\tq ", "x", "y\xa0y\u3000z\x1cz\x85", "  lead"]
    docs = spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string").coalesce(1)
    found = {r["doc_id"]: r["words"] for r in packing.word_lengths(docs).collect()}
    assert found == {r["doc_id"]: r["words"] for r in docs.select("doc_id", packing.word_length().alias("words")).collect()}


def test_words_do_not_depend_on_the_batch():
    docs = ["One two, THREE", "", "é-é x", "two"]
    hashes, counts = words(docs)
    assert counts.tolist() == [3, 0, 3, 1]
    for i, t in enumerate(docs):
        assert (words([t])[0] == hashes[sum(counts[:i]) : sum(counts[: i + 1])]).all()
    assert hashes[1] == hashes[-1]


def test_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(documents(spark, [])).collect() == []
    assert [tuple(r) for r in collected(neardup.near_duplicates(documents(spark, [None, "", "x"])))] == [(None, None), (0, 0), (3, 0), (6, 6), (6, 6)]


def slow_best_fit(lengths, sources, clusters, capacity):
    bins, placed = [], []
    for length, s, c in zip(lengths, sources, clusters, strict=True):
        fits = [(b["room"], i) for i, b in enumerate(bins) if b["room"] >= length and not b["s"] & s and not b["c"] & c]
        if fits:
            i = min(fits)[1]
        else:
            bins.append({"room": capacity, "s": 0, "c": 0})
            i = len(bins) - 1
        placed.append((i, capacity - bins[i]["room"]))
        bins[i]["room"] -= length
        bins[i]["s"] |= s
        bins[i]["c"] |= c
    return placed


def test_best_fit_equals_plain_search():
    rng = random.Random(8)
    for trial in range(30):
        n = rng.randint(0, 120)
        lengths = sorted((rng.randint(1, 50) for _ in range(n)), reverse=True)
        sources = packing.bits([rng.choice(["a", "a", "b", "c", None]) for _ in range(n)])
        clusters = packing.bits([rng.choice([1, 2, 3, None]) if rng.random() < 0.4 else 100 + i for i in range(n)])
        assert packing.best_fit(lengths, sources, clusters, 64) == slow_best_fit(lengths, sources, clusters, 64)


@pytest.mark.parametrize("config", [packing.PackingConfig(capacity=50, shard=8), packing.PackingConfig()])
def test_packing_keeps_every_word_and_every_rule(spark, config):
    docs = documents(spark)
    rows = packing.pack(docs, packing.word_length(), F.col("source"), F.xxhash64(F.coalesce("text", F.lit(""))), config=config).collect()
    known = docs.select("doc_id", F.coalesce("text", F.lit("")), "source").collect()
    source, cluster = {r[0]: r[2] for r in known}, {r[0]: r[1] for r in known}
    bins = {}
    for r in rows:
        bins.setdefault(r.bin_id, []).append(r)
    for held in bins.values():
        held.sort(key=lambda r: r.bin_offset)
        assert sum(r.length for r in held) <= config.capacity
        assert [r.bin_offset for r in held] == list(np.cumsum([0, *[r.length for r in held]])[:-1])
        sources = [source[r.doc_id] for r in held if source[r.doc_id] is not None]
        assert len(sources) == len(set(sources))
        assert len({cluster[r.doc_id] for r in held}) == len(held)
    total = docs.select(F.sum(packing.word_length())).first()[0]
    assert sum(r.length for r in rows) == total


def test_near_copies_never_share_a_sequence(spark, tmp_path):
    base = [prose(i, 60) for i in range(6)]
    rows = [(i, base[i % 6] if i < 6 else edited(base[i % 6], i, 0.01), f"s{i}") for i in range(18)]
    rows += [(None, edited(base[0], 50, 0.01), "t0"), (None, base[1], "t1"), (None, None, "t2"), (20, "", "t3")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op10_packing(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    bins = {}
    for r in found:
        bins.setdefault(r.bin_id, []).append(r.doc_id)
    for held in bins.values():
        families = [i % 6 for i in held if i is not None and i < 18]
        assert len(families) == len(set(families))
    assert len(bins) == 4  # three near copies of each text, a fourth of two of them has no id
    assert sum(r.length for r in found) == sum(len((t or "").split()) + 1 for _, t, _ in rows)


def test_packing_of_nothing(spark):
    assert packing.pack(documents(spark, []), packing.word_length(), F.col("source"), F.col("source")).collect() == []
    odd = packing.pack(documents(spark, ["a"]), F.lit(None).cast("int"), F.col("source"), F.lit(None)).collect()
    assert {r.length for r in odd} == {1}


def plain_fingerprint(text: str, config: winnow.WinnowConfig) -> list[tuple[int, int]]:
    data = text.encode()
    if not data:
        return []
    hashes = [xxhash.xxh64(data[i : i + config.gram], seed=42).intdigest() for i in range(max(1, len(data) - config.gram + 1))]
    hashes = [h - (1 << 64) if h >= 1 << 63 else h for h in hashes]
    window, found = min(config.window, len(hashes)), set()
    for i in range(len(hashes) - window + 1):
        least = min(hashes[i : i + window])
        found.add(max(j for j in range(i, i + window) if hashes[j] == least))
    return [(hashes[i], i) for i in sorted(found)]


def plain_likeness(a, b) -> float:
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_text(marks) -> str:
    return " ".join(f"{h & 0xFFFFFFFF:08x}:{i}" for h, i in marks)


@pytest.mark.parametrize("config", [winnow.WinnowConfig(), winnow.WinnowConfig(gram=3, window=4, ranges=1)])
def test_fingerprints_equal_plain_winnowing(spark, config):
    short = [t if t is None or len(t) < 5000 else t[:5000] for t in awkward_texts()] + ["ab" * 40, "a" * 90]
    docs = documents(spark, short)
    found = sorted(winnow.edited_fingerprints(docs, config=config).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    rows = sorted(((r[0], r[1]) for r in docs.select("doc_id", F.coalesce("text", F.lit(""))).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert len(found) == len(rows)
    for i, ((doc_id, text), row) in enumerate(zip(rows, found, strict=True)):
        after = rows[(i + 1) % len(rows)][1]
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        own, other, following = (plain_fingerprint(t, config) for t in (text, changed, after))
        if doc_id == rows[-1][0]:  # the repeated last row has two places
            continue
        assert (row.doc_id, row.n_chars) == (doc_id, len(text))
        assert row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert (row.fingerprint, row.edited_fingerprint) == (plain_text(own), plain_text(other))
        assert row.near_edited == pytest.approx(plain_likeness(own, other))
        assert row.near_next == pytest.approx(plain_likeness(own, following))


def test_shared_runs_share_a_mark(spark):
    config = winnow.WinnowConfig()
    run = prose(1, 30)[: config.gram + config.window - 1]
    docs = spark.createDataFrame([(1, prose(2, 20) + run + prose(3, 20)), (2, prose(4, 9) + run + prose(5, 33))], "doc_id long, text string")
    a, b = (r.marks for r in collected(winnow.fingerprints(docs, config=config)))
    common = {m.hash for m in a} & {m.hash for m in b}
    assert common
    at = {m.hash: m.position for m in a}
    assert any(docs.first().text[at[h] : at[h] + config.gram] in run for h in common)


def test_fingerprints_of_nothing(spark):
    assert winnow.edited_fingerprints(documents(spark, [])).collect() == []
    plan = winnow.edited_fingerprints(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def vectors(spark, data):
    return spark.createDataFrame([(i, v, "clash") for i, v in data], "vec_id long, embedding array<float>, id string").repartition(3)


def plain_nearest(data, wanted):
    fine = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in data if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    dimension = len(max((v for _, v in fine), key=lambda v: sum(len(x) == len(v) for _, x in fine)))
    fine = [(i, v) for i, v in fine if len(v) == dimension]
    out = {}
    for q, x in fine:
        if q % 20 == 0:
            out[q] = sorted(((-float((x * v).sum()), i) for i, v in fine if i != q))[:wanted]
    return out


def test_neighbours_equal_brute_force_where_few(spark):
    rng = np.random.default_rng(5)
    data = [(i, rng.normal(size=6).tolist()) for i in range(15)]
    data += [(100, None), (101, []), (102, [0.0] * 6), (103, [float("nan")] * 6), (104, [None] * 6), (105, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (106, [1.0, 2.0])]
    data += [(40, data[3][1]), (41, data[3][1])]
    found = {}
    for r in multiprobe.nearest(vectors(spark, data), F.col("id") % 20 == 0).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    expected = plain_nearest(data, 20)
    assert found.keys() == expected.keys()
    for q, rows in found.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(1, len(rows) + 1))
        assert [r[1] for r in rows] == [i for _, i in expected[q]]
        assert [r[2] for r in rows] == pytest.approx([-s for s, _ in expected[q]])


def test_recall(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 16))
    data = [(i, (centres[i % 30] * (1 + i % 3) + 0.4 * rng.normal(size=16)).tolist()) for i in range(1500)]
    data += [(5000 + i, data[0][1]) for i in range(400)]  # a hot bucket
    found = {}
    config = multiprobe.ProbeConfig(salt=64)
    for r in multiprobe.nearest(vectors(spark, data), F.col("id") % 20 == 0, config=config).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    expected = plain_nearest(data, 20)
    hits = [len({i for _, i in found[q]} & {i for _, i in e}) / 20 for q, e in expected.items()]
    assert np.mean(hits) >= 0.9
    assert [i for _, i in sorted(found[0])] == [i for _, i in expected[0]]  # ties to the smaller id


def test_fewer_hashes_where_the_probes_are_not_enough(spark):
    """Hashes for a far larger table, and few probes: recall stays, because the tables are fitted to them."""
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(3000, 16))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    config = multiprobe.ProbeConfig(hashes=14, most=64)
    hasher, limit = multiprobe.fitted(vectors, float(np.linalg.norm(vectors, axis=1).max()), config)
    assert hasher.config.hashes < 14 and limit <= 64
    found = multiprobe.nearest(table, F.col("id") % 100 == 0, config=config).collect()
    scores = vectors[::100] @ vectors.T
    scores[np.arange(30), np.arange(0, 3000, 100)] = -np.inf
    true = {(100 * q, int(i)) for q in range(30) for i in np.argsort(-scores[q])[:20]}
    assert len(true & {(r.query_id, r.vec_id) for r in found}) >= 0.9 * len(true)


def test_cells_follow_the_number_of_vectors(spark):
    config = multiprobe.ProbeConfig()
    assert multiprobe.cells_for(0, 64, config) == multiprobe.cells_for(10_000, 64, config) == config.cells
    for n in (20_000_000, 100_000_000):
        assert config.tables * n * 64 / multiprobe.cells_for(n, 64, config) <= config.cell
    rng = np.random.default_rng(9)
    data = [(i, rng.normal(size=4).tolist()) for i in range(60)]
    small = multiprobe.ProbeConfig(cells=1, cell=20, salt=2)
    found = {}
    for r in multiprobe.nearest(vectors(spark, data), F.col("id") % 20 == 0, config=small).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    expected = plain_nearest(data, 20)
    hits = [len({i for _, i in found[q]} & {i for _, i in e}) / 20 for q, e in expected.items()]
    assert found.keys() == expected.keys() and np.mean(hits) >= 0.9


def test_probes_come_in_order_of_cost():
    config = multiprobe.ProbeConfig(hashes=4)
    hasher = multiprobe.Hasher(3, 1.0, config)
    place = np.array([0.1, 2.7, -1.4, 5.55])
    base = np.floor(place).astype(np.int64)
    moves = np.array(np.meshgrid(*[[-1, 0, 1]] * 4, indexing="ij")).reshape(4, -1).T
    part = place - base
    cost = np.where(moves < 0, part**2, np.where(moves > 0, (1 - part) ** 2, 0)).sum(axis=1)
    order = np.argsort(cost, kind="stable")
    assert hasher.probes(place, 81).tolist() == hasher.keys(base + moves[order]).tolist()


def test_neighbours_of_nothing(spark):
    assert multiprobe.nearest(vectors(spark, []), F.col("id") % 20 == 0).collect() == []
    assert multiprobe.nearest(vectors(spark, [(0, [1.0, 0.0])]), F.col("id") % 20 == 0).collect() == []
