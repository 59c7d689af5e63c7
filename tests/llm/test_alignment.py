"""Token alignment against a plain loop over all pairs, with whole library encodings."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm.samples import awkward_texts, collected, documents
from vellum.llm import alignment
from vellum.llm.alignment import AlignmentConfig, alignment_digests, byte_level, token_links

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["<|endoftext|> in a text", "<s> </s> <0x41> <unk>", "▁ is a sign", "a▁b", " leading", "trailing ", "a b", " ", "\ta\n", "naïve \U0001f600\U0001f600 漢字", "don't we'll I'm", "\x00 \x01", "x  y", " y 　 z"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def spans(libraries, text):
    """[(id, start, end)] of both sides, or none."""
    a, b = libraries
    letters = byte_level()
    raw = (" " + text).encode() if text else b""
    ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
    ids_b = b.encode(text) if text else []
    side_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    side_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if b"".join(side_a) != raw or b"".join(side_b) != raw:
        return [], []
    out = []
    for ids, parts in ((ids_a, side_a), (ids_b, side_b)):
        at, rows = 0, []
        for i, p in zip(ids, parts, strict=True):
            rows.append((i, at, at + len(p)))
            at += len(p)
        out.append(rows)
    return out


def plain(libraries, rows):
    per, counts = [], Counter()
    for doc_id, text in rows:
        a, b = spans(libraries, text)
        links, j = [], 0
        for i, (x, s, e) in enumerate(a):
            while j and b[j][1] > s:
                j -= 1
            while j < len(b) and b[j][1] < e:
                if b[j][2] > s:
                    links.append((i, j, x, b[j][0]))
                j += 1
            j = max(0, j - 1)
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, lo = [], 0
        for hi in ends:
            groups.append("|".join(",".join(str(i) for i, s, e in side if lo <= s and e <= hi) for side in (a, b)))
            lo = hi
        counts.update({(x, y) for _, _, x, y in links})
        per.append((doc_id, a, b, links, ends, groups))
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, a, b, links, ends, groups in per:
        best = sum(counts[x, y] == most[x] for _, _, x, y in links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((doc_id, len(a), len(b), len(ends), len(links), best, sum(counts[x, y] for _, _, x, y in links), sha))
    return sorted(out, key=str), per


def test_equals_plain_loop(spark, libraries):
    docs = documents(spark, [*awkward_texts(), *ODD])
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    expected, per = plain(libraries, rows)
    for config in (None, AlignmentConfig(batch=500)):
        assert sorted(map(tuple, alignment_digests(docs, A, B, config=config).collect()), key=str) == expected
    assert sum(r[1] > 0 for r in expected) > 40 and any(r[1] == 0 for r in expected)
    links = {r["doc_id"]: r for r in collected(token_links(docs, A, B)) if r["doc_id"] is not None}
    for doc_id, a, b, pairs, ends, _ in per:
        if doc_id is not None:
            r = links[doc_id]
            assert r["a_ids"] == [i for i, _, _ in a] and r["b_ids"] == [i for i, _, _ in b]
            assert r["a_ends"] == [e for _, _, e in a] and r["group_ends"] == ends
            assert sorted(map(tuple, r["links"])) == sorted((i, j) for i, j, _, _ in pairs)


def test_empty_table_and_no_tokens(spark):
    assert alignment_digests(documents(spark, []), A, B).collect() == []
    found = alignment_digests(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), A, B).collect()
    assert sorted(map(tuple, found)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_a_process_holds_a_bounded_table_and_aligns_small_parts(monkeypatch):
    """The words that are kept and the texts that are aligned at once are bounded, however large a batch is."""
    sizes, align = [], alignment.align
    monkeypatch.setattr(alignment, "align", lambda a, b: sizes.append(int(a["end"].max())) or align(a, b))
    monkeypatch.setattr(alignment, "SIDES", {})
    docs = [" ".join(f"w{i}x{j}" for j in range(20)) for i in range(400)]
    run, held = alignment_batches(docs, AlignmentConfig(batch=1 << 20, part=4096, kept=500))
    assert len(run) == 1 and max(sizes) <= 4096 + len(docs)
    assert len(held.words.number) <= 500 + 4096 and len(held.older.number) <= 500 + 4096
    assert run[0].column("doc_ids")[0].as_py() == list(range(400))
    whole, _ = alignment_batches(docs, AlignmentConfig(batch=1 << 20, part=1 << 20))
    assert run[0].drop_columns(["batch"]).equals(whole[0].drop_columns(["batch"]))


def alignment_batches(docs, config):
    """What one task sends for the texts, and the table of its process."""
    import pyarrow as pa

    rows = pa.RecordBatch.from_arrays([pa.array(range(len(docs)), pa.int64()), pa.array(docs)], ["id", "text"])
    return [*alignment.batch_links(iter([rows]), A, B, config, 0)], alignment.both_sides(A, B, config.kept)
