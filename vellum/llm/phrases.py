"""Phrase collocation mining with Rabin-Karp fingerprints.

Texts are lower-cased (A to Z), cut into pieces at ``.,;:!?`` and line ends and into words at blanks and tabs. Prefix
polynomials over the words' hashes give the fingerprint of every run of one to ``longest`` words inside a piece. Each pack
of texts sends its distinct fingerprints with their counts, and the pack and place stand for the occurrence; the shuffle
adds them up, and a pack learns which of its fingerprints reach ``least``. Only those are looked up in the text: every
occurrence is compared with the first one word by word, so phrases that share a fingerprint are told apart, and phrases
and exact counts are added up in a second shuffle. What is rare is never written out as text.

A candidate has 2 to ``longest`` words and a = f(phrase) >= ``least``. Cut after k words it scores floor(10^6 a^2 / (l r))
with l, r the counts of its parts; the lowest cut counts, of equal ones the first. A candidate is dropped if a longer one
contains it with at least half its count. Counts, cuts and scores are made for each language (null: ``und``), scores in
decimals of 38 digits.

Null texts are empty. Texts without words, empty tables and languages without candidates give no rows. Repeated rows
count each time. A text of any length is one unit of a pack. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm import packs
from vellum.llm.common import write_shared
from vellum.llm.packs import INVERSE, Pack, U, mix, powers, prefix_sums


@dataclass(frozen=True)
class PhraseConfig:
    """least: count of a candidate. longest: words. share: percent of a candidate's count that a longer one must have
    to replace it. pack: bytes of texts seen at once. bucket: fingerprints that meet in one group, on average."""

    least: int = 10
    longest: int = 3
    share: int = 50
    pack: int = 4 << 20
    bucket: int = 1 << 20


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: 0 a word's byte, 1 a blank, 2 the end of a piece
KIND = np.zeros(256, dtype=np.int8)
KIND[[0x20, 0x09]] = 1
KIND[[*map(ord, ".,;:!?"), 0x0A, 0x0B, 0x0C, 0x0D]] = 2
SLICE = 1 << 20


@dataclass
class Words:
    """Words of a pack: bytes lower-cased, begin and end of each word, its hash, its piece, the number of its text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    piece: np.ndarray
    text: np.ndarray

    def phrase(self, at: int, n: int) -> bytes:
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[at : at + n], self.end[at : at + n], strict=True))


def words(pack: Pack) -> Words:
    """Find and hash the words, some texts at a time."""
    data = LOWER[pack.data]
    found, before = [], 0
    for lo, hi in packs.slices(pack.sizes.tolist(), SLICE):
        first, last = int(pack.starts[lo]), int(pack.starts[hi - 1] + pack.sizes[hi - 1])
        part = data[first:last]
        kind = KIND[part]
        # a word ends where its text ends, even if the next text begins with a letter
        borders = pack.starts[lo:hi] - first
        inside = kind == 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        heads = borders[borders < len(part)]
        begins[heads] = inside[heads]
        start = np.flatnonzero(begins)
        stop = ~inside
        stop[heads] = True
        ends = np.append(np.flatnonzero(stop), len(part))
        end = ends[np.searchsorted(ends, start, side="right")]
        sums = prefix_sums(part.astype(U) + U(1))
        hashes = mix((sums[end] - sums[start]) * powers(INVERSE, len(part) + 1)[start] + (end - start).astype(U))
        breaks = kind == 2
        piece = np.cumsum(breaks)[start] if len(part) else np.zeros(0, np.int64)
        text = np.searchsorted(borders, start, side="right") - 1 + lo
        found.append((start + first, end + first, hashes, piece + before, text))
        before += int(breaks.sum()) + 1
    columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 5
    return Words(data, columns[0], columns[1], columns[2].astype(U), columns[3], columns[4])


def seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def fingerprints(pack: Pack, w: Words, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprint, first word, number of words) of every run of words inside a piece; the language is part of the hash."""
    seeds = np.array([seed(k) for k in pack.keys], dtype=U)[w.text] if len(w.text) else np.zeros(0, U)
    sums, back = prefix_sums(w.hash), powers(INVERSE, len(w.hash))
    prints, at, size = [], [], []
    for n in range(1, longest + 1):
        i = np.arange(max(0, len(w.hash) - n + 1))
        if n > 1:
            i = i[(w.piece[i] == w.piece[i + n - 1]) & (w.text[i] == w.text[i + n - 1])]
        prints.append(mix((sums[i + n] - sums[i]) * back[i] ^ (seeds[i] + U(n))))
        at.append(i)
        size.append(np.full(len(i), n, dtype=np.int8))
    return np.concatenate(prints), np.concatenate(at), np.concatenate(size)


def distinct(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the fingerprints, where each distinct one begins in that order, and how often it occurs."""
    order = np.argsort(prints)
    ordered = prints[order]
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    return order, first, np.diff(np.append(first, len(ordered)))


def same_words(w: Words) -> np.ndarray:
    """A number for each word, equal for words of equal bytes only."""
    order, first, sizes = distinct(w.hash)
    number = np.empty(len(w.hash), dtype=np.int64)
    number[order] = np.repeat(order[first], sizes)  # a word of the same hash
    length = w.end - w.start
    wrong = length != length[number]
    todo = np.flatnonzero(~wrong & (number != np.arange(len(number))))
    for lo in range(0, len(todo), 1 << 17):
        part = todo[lo : lo + (1 << 17)]
        n = length[part]
        ends = np.cumsum(n)
        within = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - n, n)
        other = w.data[within + np.repeat(w.start[part], n)] != w.data[within + np.repeat(w.start[number[part]], n)]
        if other.any():
            wrong[part[np.repeat(np.arange(len(part)), n)[other]]] = True
    seen: dict[bytes, int] = {}
    for i in np.flatnonzero(wrong).tolist():  # words that only share a hash
        number[i] = seen.setdefault(w.phrase(i, 1), i)
    return number


def verified(pack: Pack, w: Words, prints: np.ndarray, at: np.ndarray, size: np.ndarray, wanted: np.ndarray) -> pa.RecordBatch:
    """(lang, words, phrase, count) of the wanted fingerprints, occurrences of other words counted as other phrases."""
    order, first, sizes = distinct(prints)
    leader = order[np.repeat(first, sizes)]
    number = same_words(w)
    keep = np.repeat(wanted, sizes)
    occurrence, leader = order[keep], leader[keep]
    equal = size[occurrence] == size[leader]
    for j in range(int(size.max(initial=0))):
        there = equal & (size[occurrence] > j)
        a, b = at[occurrence[there]] + j, at[leader[there]] + j
        equal[there] &= number[a] == number[b]
    langs = np.array(pack.keys, dtype=object)
    equal &= langs[w.text[at[occurrence]]] == langs[w.text[at[leader]]]
    head, n = np.unique(leader[equal], return_counts=True)
    rows = np.concatenate([head, occurrence[~equal]])
    counts = np.concatenate([n, np.ones(len(rows) - len(head), n.dtype)])
    return phrase_rows(pack, w, at[rows], size[rows].astype(np.int64), counts)


def phrase_rows(pack: Pack, w: Words, at: np.ndarray, size: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """(lang, words, phrase, count) of phrases given by their first word and length.

    Words with single blanks between them are one slice of the text; where other white space stands the blanks are written.
    """
    start, end = w.start[at], w.end[at + size - 1]
    plain = np.ones(len(at), dtype=bool)
    for j in range(int(size.max(initial=0)) - 1):
        there = size > j + 1
        gap = w.end[at[there] + j]
        plain[there] &= (w.start[at[there] + j + 1] == gap + 1) & (w.data[gap] == 0x20)
    order = np.argsort(~plain, kind="stable")
    at, size, counts, start, length = at[order], size[order], counts[order], start[order], (end - start)[order]
    first = int(plain.sum())
    ends = np.cumsum(length[:first])
    total = int(ends[-1]) if first else 0
    flat = w.data[np.arange(total) + np.repeat(start[:first] - ends + length[:first], length[:first])]
    odd = [w.phrase(i, k) for i, k in zip(at[first:].tolist(), size[first:].tolist(), strict=True)]
    offsets = np.concatenate([[0], ends, total + np.cumsum([len(x) for x in odd], dtype=np.int64)]).astype(np.int32)
    phrases = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(flat.tobytes() + b"".join(odd)))
    langs = pa.array(pack.keys, pa.string()).take(pa.array(w.text[at]))
    columns = [langs, pa.array(size, pa.int32()), phrases, pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "words", "phrase", "count"])


COUNTED = "lang string, words int, phrase string, count long"


def frequent_phrases(docs: DataFrame, lang: Column, text_col: str = "text", config: PhraseConfig | None = None) -> DataFrame:
    """(lang, words, phrase, count) of all phrases that occur often enough; words 0 has the number of all words."""
    config = config or PhraseConfig()
    key = F.coalesce(lang.cast("string"), F.lit("und"))
    stored = packs.make_packs(docs, key, config.pack, text_col)
    buckets = max(1, -(-packs.total_bytes(stored) * 3 // 10 // config.bucket))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, _ in packs.unpacked(batches):
            prints, _, _ = fingerprints(pack, words(pack), config.longest)
            prints.sort()
            new = np.ones(len(prints), dtype=bool)
            new[1:] = prints[1:] != prints[:-1]
            first = np.flatnonzero(new)
            yield packs.sent(pack.number, prints[first], np.diff(np.append(first, len(prints))), buckets)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, row in packs.unpacked(batches):
            w = words(pack)
            prints, at, size = fingerprints(pack, w, config.longest)
            order, first, _ = distinct(prints)
            wanted = packs.received(row["answers"], prints[order[first]], buckets)[0]
            found = verified(pack, w, prints, at, size, wanted)
            langs, numbers = np.unique(np.array(pack.keys, dtype=object), return_inverse=True)
            totals = np.bincount(numbers[w.text], minlength=len(langs)) if len(w.text) else np.zeros(len(langs), np.int64)
            words_of = [langs.tolist(), [0] * len(langs), [""] * len(langs), totals.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(words_of, found.schema, strict=True)], found.schema.names)
            yield found

    keys = stored.mapInArrow(send, packs.SENT)
    least = config.least
    answers = packs.marked(keys, lambda total, n: [total >= least])
    counted = stored.join(answers, "pack", "left").mapInArrow(look_up, COUNTED)
    total = counted.groupBy("lang", "words", "phrase").agg(F.sum("count").alias("count"))
    return write_shared(total.filter((F.col("words") == 0) | (F.col("count") >= least)), "phrases")


def collocations(
    docs: DataFrame, lang: Column, top: int | None = None, text_col: str = "text", config: PhraseConfig | None = None
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): scored candidates that no longer one replaces, the best first; all without ``top``."""
    config = config or PhraseConfig()
    counted = frequent_phrases(docs, lang, text_col, config)
    counts = counted.filter("words > 0").select("lang", "words", "phrase", F.col("count").alias("a"))
    candidates = counts.filter("words > 1").withColumn("parts", F.split("phrase", " "))
    k = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = candidates.select("lang", "words", "phrase", "a", "parts", k).select(
        "lang", "words", "phrase", "a", "k",
        F.array_join(F.slice("parts", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("parts", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right"),
    )
    of = lambda side, name: counts.select("lang", F.col("phrase").alias(side), F.col("a").alias(name))
    cuts = cuts.join(of("left", "l"), ["lang", "left"]).join(of("right", "r"), ["lang", "right"])
    big = lambda c: F.col(c).cast("decimal(15,0)")
    cuts = cuts.withColumn("aa", big("a") * big("a") * F.lit(1_000_000).cast("decimal(7,0)")).withColumn("lr", big("l") * big("r"))
    cuts = cuts.withColumn("score", F.expr("aa div lr"))
    scored = cuts.groupBy("lang", "phrase").agg(
        F.first("words").alias("words"), F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("best")
    )
    longer = candidates.filter("words > 2").select("lang", F.col("a").alias("other"), "parts", "words")
    # every shorter run of its words
    inner = longer.select(
        "lang", "other", "parts", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")
    ).select("lang", "other", "parts", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("from"))
    inner = inner.select("lang", F.array_join(F.slice("parts", F.col("from"), F.col("size")), " ").alias("phrase"), "other")
    most = inner.groupBy("lang", "phrase").agg(F.max("other").alias("other"))
    kept = scored.join(most, ["lang", "phrase"], "left").filter(
        F.col("other").isNull() | (F.col("other") * 100 < F.col("a") * config.share)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    sizes = counted.filter("words = 0").select("lang", F.col("count").alias("n"))
    return ranked.join(sizes, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"),
        "n", F.col("best.score").cast("long").alias("score"),
    )
