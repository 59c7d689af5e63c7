"""Repeated strings against a plain set of all strings, and the merge against sorting."""

import hashlib
import random

import numpy as np
import pytest

from llm.samples import awkward_texts, documents, prose
from vellum.llm import packs, suffixes
from vellum.llm.suffixes import SuffixConfig, repeat_digests, repeated_spans

LAST = suffixes.LAST


def plain(rows, length=50):
    """(id, bytes, removed, spans, digest) by a dictionary of all strings."""
    first = {}
    for doc_id, text in rows:
        raw, key = (text or "").encode(), LAST if doc_id is None else doc_id
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            first[s] = min(first.get(s, LAST), key)
    out = []
    for doc_id, text in rows:
        raw, key = (text or "").encode(), LAST if doc_id is None else doc_id
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < key:
                gone[i : i + length] = b"\x01" * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((doc_id, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts():
    shared, other = prose(700, 60), prose(701, 30)
    return [
        *awkward_texts(), shared, "before " + shared, shared + " after", other + shared, shared[:120], shared[10:59], shared[10:60], shared[10:61],
        shared + shared, "ab" * 300, "ab" * 40 + "c" + "ab" * 200, "ü" * 60, "xü" + "ü" * 40, "x" * 49, "x" * 50, "x" * 51, "\x00" * 70, "\x00" * 90,
    ]


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


@pytest.mark.parametrize("config", [SuffixConfig(), SuffixConfig(pack=3000, bucket=200, group=5000, shard=700), SuffixConfig(hot=1, gram=8, pack=20_000, shard=5000), SuffixConfig(length=20, gram=20, pack=9000)])
def test_equals_plain_dictionary(spark, config):
    docs = documents(spark, texts())
    found = sorted(map(tuple, repeat_digests(docs, config=config).collect()), key=str)
    expected = plain(rows_of(docs), config.length)
    assert found == expected and sum(r[2] for r in expected) > 5000


def test_spans_and_bytes(spark):
    docs = documents(spark, texts()[-18:])
    for r in repeated_spans(docs, config=SuffixConfig(pack=500)).join(docs.select("doc_id", "text"), "doc_id").collect():
        raw, kept, last = r["text"].encode(), b"", 0
        for lo, hi in r["spans"]:
            assert last < lo or lo == 0
            kept, last = kept + raw[last:lo], hi
        assert kept + raw[last:] == bytes(r["kept"])


def test_ids_decide_not_the_order_of_rows(spark):
    text = prose(5, 40)
    rows = [(9, text), (-4, text), (None, text), (None, text), (-4, text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {(r["doc_id"], r["n_removed"]) for r in repeat_digests(docs).collect()}
    assert found == {(9, len(text)), (-4, 0), (None, len(text))}


def test_empty_table(spark):
    assert repeat_digests(documents(spark, [])).collect() == []


def test_merge_equals_sorting():
    rng = random.Random(3)
    for trial in range(60):
        letters = bytes(rng.sample(range(256), rng.choice([1, 2, 3, 30])))
        strings = [bytes(rng.choices(letters, k=rng.randint(12, 40))) for _ in range(rng.randint(1, 30))]
        strings += rng.choices(strings, k=5)
        config = SuffixConfig(length=12, gram=8, shard=rng.choice([30, 100, 10_000]))
        docs = np.array([rng.randint(0, 9) for _ in strings])
        data = np.frombuffer(b"".join(strings), dtype=np.uint8)
        found = suffixes.first_holders(data, np.array([len(s) for s in strings]), docs, config)
        first, at = {}, 0
        for s, d in zip(strings, docs.tolist(), strict=True):
            for i in range(len(s) - 11):
                first[s[i : i + 12]] = min(d, first.get(s[i : i + 12], 99))
        for s in strings:
            for i in range(len(s) - 11):
                assert found[at + i] == first[s[i : i + 12]], trial
            at += len(s)


def test_suffix_order_equals_sorting():
    rng = random.Random(4)
    for _ in range(60):
        strings = [bytes(rng.choices(range(1, rng.choice([2, 3, 200])), k=rng.randint(1, 70))) for _ in range(rng.randint(1, 20))]
        strings += strings[:3]
        codes = np.frombuffer(b"".join(s + b"\0" for s in strings), dtype=np.uint8)
        suffix = [(s[i:], at + i) for s, at in zip(strings, np.cumsum([0] + [len(s) + 1 for s in strings]).tolist(), strict=False) for i in range(len(s) + 1)]
        room = np.array([len(s) for s, _ in suffix])
        assert suffixes.suffix_order(codes, room).tolist() == [at for _, at in sorted(suffix)]


def test_runs_hold_every_string_once_and_equal_strings_share_a_key():
    docs = [t.encode() for t in texts() if t]
    data, sizes = np.frombuffer(b"".join(docs), dtype=np.uint8), np.array([len(d) for d in docs])
    pack = packs.Pack(0, list(range(len(docs))), sizes, np.cumsum(sizes) - sizes, data)
    config = SuffixConfig()
    found = suffixes.runs(pack, config)
    keys, seen = {}, []
    for start, count, key, doc in zip(found.start.tolist(), found.count.tolist(), found.key.tolist(), found.doc.tolist(), strict=True):
        for i in range(start, start + count):
            seen.append(i)
            assert pack.starts[doc] <= i and i + 50 <= pack.starts[doc] + sizes[doc]
            assert keys.setdefault(data[i : i + 50].tobytes(), key) == key
    assert sorted(seen) == [int(s) + i for s, n in zip(pack.starts, sizes, strict=True) for i in range(n - 49)]
