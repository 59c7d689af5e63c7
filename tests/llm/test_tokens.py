import base64
import hashlib
import math
import random
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from llm.samples import awkward_texts, collected, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vellum.llm import bpe, lattice, tokenfiles
from vellum.session import scratch_path

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "漢", "😀", "'s", "'", "1", "!!", "　", "A", "\x00"]


@pytest.fixture(scope="module")
def own():
    return bpe.ByteBpe(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_merges(own, library):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += ["".join(chr(rng.randint(1, 0x2FF)) for _ in range(60)) for _ in range(500)]
    texts += ["a" * 4000, " " * 3000, "ab" * 4000, "=" * 999 + "x", "\n" * 777]
    for text in texts:
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_compatibility_equals_merging_both(own):
    rng = random.Random(2)
    tokens = list(own.bytes)
    for _ in range(5000):
        left, right = rng.choice(tokens), rng.choice(tokens[:3000])
        assert own.compatible(left, right) == (own.merge(own.bytes[left] + own.bytes[right]) == [left, right])


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 3)
    small = bpe.ByteBpe(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    for text in ["one two three four five six", "six five four", "one two three"] * 3:
        assert small.encode(text) == library.encode_ordinary(text)


def test_bpe_query(spark, library):
    docs = documents(spark)
    found = collected(bpe.bpe_digests(docs, RANKS, public_tokenizers.PATTERN))
    texts = collected(docs.select("doc_id", F.coalesce("text", F.lit(""))))
    assert len(found) == len(texts)
    for row, (doc_id, text) in zip(found, texts, strict=True):
        ids = library.encode_ordinary(text)
        assert (row.doc_id, row.n_tokens) == (doc_id, len(ids))
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_round_trip(spark):
    docs = documents(spark)
    back = bpe.bpe_text(bpe.bpe_ids(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert [(r.doc_id, bytes(r.data).decode()) for r in collected(back)] == [tuple(r) for r in collected(docs.select("doc_id", F.coalesce("text", F.lit(""))))]


@pytest.mark.parametrize("bits", [1, 3, 8, 13, 16, 17, 32])
def test_packed_ids(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000).astype(np.uint32)
    payload = tokenfiles.pack_ids(ids, bits)
    assert len(payload) == -(-1000 * bits // 8)
    assert (tokenfiles.unpack_ids(payload, bits, 0, 1000) == ids).all()
    assert (tokenfiles.unpack_ids(payload, bits, 137, 611) == ids[137:611]).all()
    assert tokenfiles.bits_for(1 << bits) == bits


@pytest.mark.parametrize("block", [1, 50, 1 << 16])
def test_token_files(spark, block):
    docs = documents(spark, [*awkward_texts(), "hello <|endoftext|> world", "<|endoftext|>", " x<|endoftext|>y z"])
    found = tokenfiles.token_digests(docs, JSON, tokenfiles.TokenFileConfig(block=block)).collect()
    rows = sorted(((r[0], r[1]) for r in docs.select("doc_id", F.coalesce("text", F.lit(""))).collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    library = Tokenizer.from_file(JSON)
    expected, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected


def test_token_files_hold_ids_in_order(spark):
    docs = documents(spark).filter("doc_id IS NOT NULL")
    path = scratch_path(spark, "tokens")
    tokenfiles.write_token_files(docs, JSON, path, config=tokenfiles.TokenFileConfig(block=100))
    blocks = tokenfiles.read_token_index(spark, path).orderBy("first").collect()
    ids = [i for b in blocks for i in b.doc_ids]
    assert ids == sorted(ids) and len(blocks) > 5 and {b.bits for b in blocks} == {16}


def test_added_tokens_are_those_of_the_plain_call():
    ids, counts = tokenfiles.text_encoder(JSON).encode(["hello <|endoftext|> world", "a b"])
    assert ids.tolist() == [31373, 220, 50256, 995, 64, 275] and counts.tolist() == [4, 2]


def test_rows_without_id_are_many_ranges(spark):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.md5(F.col("id").cast("string"))).alias("text"))
    path = scratch_path(spark, "tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tokenfiles.write_token_files(docs.repartition(8), JSON, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["n"] for r in spark.read.parquet(path).groupBy("shard").agg(F.sum(F.size("doc_ids")).alias("n")).collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 2 * 3000 / len(sizes) and len(sizes) > 2


def brute_lattice(model: lattice.Lattice, data: bytes) -> float:
    """Sum over all segmentations by recursion."""
    if not data:
        return 1.0
    return sum(math.exp(w) * brute_lattice(model, data[j:]) for j in range(1, len(data) + 1) if (w := model.table.get(data[:j])) is not None)


def test_lattice_sums_all_segmentations():
    model = lattice.first_lattice(lattice.read_pieces(PIECES), 100.0)
    for word in (b"a", b"the", b"thing", "naïve".encode(), "漢".encode(), b"\xff\x00"):
        assert math.isclose(math.exp(model.log_probability(word)), brute_lattice(model, b" " + word), rel_tol=1e-9)


def test_expected_uses():
    model = lattice.first_lattice(lattice.read_pieces(PIECES), 100.0)
    for word in (b"thing", b"the"):
        short, uses = dict(), dict()
        for piece, share in model.short_uses(b" " + word):
            short[piece] = short.get(piece, 0) + share
        limit, lattice.SHORT = lattice.SHORT, 0
        try:
            for piece, share in model.uses(word):
                uses[piece] = uses.get(piece, 0) + share
        finally:
            lattice.SHORT = limit
        assert short.keys() == uses.keys() and all(math.isclose(short[p], uses[p], rel_tol=1e-9) for p in uses)
        assert math.isclose(sum(share * len(model.names[p]) for p, share in uses.items()), len(word) + 1, rel_tol=1e-3)


def test_words_and_end_have_probability_one():
    names = [b" ", b" a", b"a", b"b", b"ab"]
    model = lattice.fitted(names, np.array([1.0, 2.0, 3.0, 1.0, 2.0]), per_end=4.0)
    total, level = math.exp(model.end), [b""]
    for _ in range(12):
        total += sum(math.exp(model.log_probability(w)) for w in level)
        level = [w + c for w in level for c in (b"a", b"b")]
    assert 0.9 < total <= 1 + 1e-9


@pytest.mark.parametrize("chunk", [1, 8 << 20])
def test_lattice_scores(spark, chunk):
    docs = documents(spark)
    train = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    found = collected(lattice.lattice_scores(docs, PIECES, train, config=lattice.LatticeConfig(chunk=chunk)))
    rows = collected(docs.select("doc_id", F.coalesce("text", F.lit(""))))
    counts, ends = Counter(), 0
    for doc_id, text in rows:
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2:
            counts.update(text.encode().lower().split())
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    by_id = {}
    for doc_id, text in rows:
        words = text.encode().lower().split()
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((ends + 1) / (n + v + 1))
        by_id[doc_id] = (len(words) + 1, sum(counts[w] > 0 for w in words) + 1, n, base)
    assert len(found) == len(rows)
    for row in found:
        expected = by_id[row.doc_id]
        assert (row.n_tokens, row.n_known, row.train_tokens) == expected[:3]
        assert math.isclose(row.base_score, expected[3], rel_tol=1e-9) and row.score < 0


def test_files_hold_few_chunks(spark, monkeypatch):
    stored, write = {}, lattice.write_shared

    def kept(df, name, *more):
        stored[name] = write(df, name, *more)
        return stored[name]

    monkeypatch.setattr(lattice, "write_shared", kept)
    docs = documents(spark).coalesce(1)
    assert lattice.lattice_scores(docs, PIECES, F.lit(True), config=lattice.LatticeConfig(chunk=1)).count() == docs.count()
    rows = [r["n"] for r in stored["chunks"].groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert sum(rows) >= 30 and max(rows) <= 2


def test_token_operators_take_empty_tables(spark):
    docs = documents(spark, [])
    assert bpe.bpe_digests(docs, RANKS, public_tokenizers.PATTERN).collect() == []
    assert tokenfiles.token_digests(docs, JSON).collect() == []
    assert lattice.lattice_scores(docs, PIECES, F.lit(True)).collect() == []
    alone = documents(spark, ["a b", None])
    assert {r.train_tokens for r in lattice.lattice_scores(alone, PIECES, F.lit(False)).collect()} == {0}


def test_new_words_take_no_call_of_python_each():
    encoder = tokenfiles.TextEncoder(JSON)
    text, calls = " ".join(f"w{i}" for i in range(3000)), []
    sys.setprofile(lambda frame, event, _: calls.append(event) if event == "call" else None)
    try:
        ids, counts = encoder.encode([text])
    finally:
        sys.setprofile(None)
    assert ids.tolist() == Tokenizer.from_file(JSON).encode(text, add_special_tokens=False).ids and len(calls) < 1500


def test_words_with_other_signs_share_their_letters_ids():
    """A word and the signs behind it are units of their own, so the library is asked once for the word; ids are those of the plain call."""
    encoder, library = tokenfiles.TextEncoder(JSON), Tokenizer.from_file(JSON)
    texts = ["thonre thonre, Thonre&&& thonre.\nThonre 'thonre' thonre's 12thonre\xa0thonre é\né,", "a\x1cb,\u3000c 1's,'s 't's' x\u200by \x85 z", "", "it's,", "\n", "a\n b"]
    rng = random.Random(3)
    texts += ["".join(rng.choices([*PARTS, ",", "&&", "re", "’", "\u0301"], k=rng.randint(0, 20))) for _ in range(2000)]
    ids, counts = encoder.encode(texts)
    at = np.cumsum(counts)
    assert [ids[lo:hi].tolist() for lo, hi in zip(at - counts, at, strict=True)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    encoder = tokenfiles.TextEncoder(JSON)
    encoder.encode(texts[:1])
    assert {" thonre", ",", "&&&", "Thonre"} <= set(encoder.table.words.number) and " thonre," not in encoder.table.words.number
