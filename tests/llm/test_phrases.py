"""Collocations against a plain count, collisions, and awkward tables."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from llm.samples import awkward_texts, documents, prose
from vellum.llm import packs, phrases
from vellum.llm.phrases import PhraseConfig, collocations, frequent_phrases

SMALL = PhraseConfig(least=3, pack=4000, bucket=200)


def grams(texts, longest=3):
    """Counts of all phrases by language, and of all words."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in texts:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    f[lang][" ".join(words[i : i + size])] += 1
    return f, n


def plain(texts, least, top=None):
    f, n = grams(texts)
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if " " in p and a >= least}
        rows = []
        for p, a in cand.items():
            w = p.split(" ")
            cuts = [(10**6 * a * a // (counts[x] * counts[y]), k, counts[x], counts[y])
                    for k in range(1, len(w)) for x, y in [(" ".join(w[:k]), " ".join(w[k:]))]]
            longer = [b for q, b in cand.items() if len(q.split(" ")) > len(w) and f" {p} " in f" {q} "]
            if not any(100 * b >= 50 * a for b in longer):
                score, _, x, y = min(cuts)
                rows.append((score, a, p, x, y))
        rows.sort(key=lambda r: (-r[0], -r[1], r[2].encode()))
        out += [(lang, i + 1, p, a, x, y, n[lang], s) for i, (s, a, p, x, y) in enumerate(rows[:top])]
    return sorted(out)


def texts_of(df):
    return [(r["text"], r["lang"]) for r in df.select("text", "lang").collect()]


def test_equals_plain_count(spark):
    docs = documents(spark, [*awkward_texts(), "New York New York, NEW York! new york\tnew\x0byork", "ab a", "b c", "a b a b a b a b a"])
    found = sorted(map(tuple, collocations(docs, F.col("lang"), config=SMALL).collect()))
    assert found == plain(texts_of(docs), 3) and len(found) > 100
    top = sorted(map(tuple, collocations(docs, F.col("lang"), top=7, config=SMALL).collect()))
    assert top == plain(texts_of(docs), 3, 7)


def test_pack_size_changes_nothing(spark):
    docs = documents(spark)
    one = sorted(map(tuple, frequent_phrases(docs, F.col("lang"), config=PhraseConfig(least=2)).collect()))
    many = sorted(map(tuple, frequent_phrases(docs, F.col("lang"), config=PhraseConfig(least=2, pack=1, bucket=50)).collect()))
    assert one == many


def test_empty_table(spark):
    assert collocations(documents(spark, []), F.col("lang")).collect() == []


def test_phrases_that_share_a_fingerprint_are_told_apart():
    texts = [prose(1, 300).replace(".", "").lower(), "x y x y x y"]
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts])
    pack = packs.Pack(1, ["en", "fr"], sizes, np.cumsum(sizes) - sizes, data)
    w = phrases.words(pack)
    w.hash = w.hash % np.uint64(7)  # words share hashes
    prints, at, size = phrases.fingerprints(pack, w, 3)
    prints = prints % np.uint64(5)  # and phrases of any length and language share fingerprints
    everything = np.ones(len(np.unique(prints)), dtype=bool)
    found: Counter = Counter()
    for r in pa.Table.from_batches([phrases.verified(pack, w, prints, at, size, everything)]).to_pylist():
        found[r["lang"], r["phrase"]] += r["count"]
    f, _ = grams(list(zip(texts, ["en", "fr"], strict=True)))
    assert found == Counter({(lang, p): a for lang, c in f.items() for p, a in c.items()})


def test_white_space_inside_a_phrase_is_one_blank():
    text = "a b\tc  d e"
    pack = packs.Pack(1, ["en"], np.array([len(text)]), np.array([0]), np.frombuffer(text.encode(), dtype=np.uint8))
    w = phrases.words(pack)
    at, size = np.array([0, 0, 2, 3, 1]), np.array([2, 3, 2, 2, 1])
    rows = phrases.phrase_rows(pack, w, at, size, np.array([1, 2, 3, 4, 5])).to_pylist()
    assert sorted((r["phrase"], r["words"], r["count"]) for r in rows) == [("a b", 2, 1), ("a b c", 3, 2), ("b", 1, 5), ("c d", 2, 3), ("d e", 2, 4)]
