"""Text search over a postings table (doc_id, term, positions).

A search is given as an expression tree. Its words are filtered at the postings scan, the postings of those words
alone are grouped per document, and the tree becomes one condition on the grouped positions. So the shuffle
carries the postings of the searched words and nothing else, whatever the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vellum.functions.text import STOP_WORDS, light_stem, tokens


@dataclass(frozen=True)
class Term:
    """A word; ``*`` stands for any run of letters. ``stemmed`` looks for the word's stem, for an index of stems."""

    text: str
    stemmed: bool = False

    def matches(self) -> Column:
        word = self.text.lower()
        if self.stemmed and "*" not in word:
            return F.col("term") == light_stem(F.lit(word))
        if "*" in word:
            quoted = word.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
            return F.col("term").like(quoted.replace("*", "%"))
        return F.col("term") == word


@dataclass(frozen=True)
class AnyOf:
    """One of several words, for use as a word of a phrase."""

    words: tuple[Term, ...]

    def matches(self) -> Column:
        condition = self.words[0].matches()
        for word in self.words[1:]:
            condition = condition | word.matches()
        return condition


@dataclass(frozen=True)
class Phrase:
    """Words in order; ``gaps[i]`` is the exact distance from word i to word i + 1, one when not given."""

    words: tuple[Term | AnyOf, ...]
    gaps: tuple[int, ...] = ()

    def __post_init__(self) -> None:
        if self.gaps and len(self.gaps) != len(self.words) - 1:
            raise ValueError(f"{len(self.words)} words have {len(self.words) - 1} gaps, but {len(self.gaps)} were given")


@dataclass(frozen=True)
class Near:
    """Two words at most ``distance`` apart, in either order."""

    left: Term | AnyOf
    right: Term | AnyOf
    distance: int


@dataclass(frozen=True)
class And:
    parts: tuple


@dataclass(frozen=True)
class Or:
    parts: tuple


@dataclass(frozen=True)
class Not:
    part: object


#: Texts grouped at once.
GROUPED = 1024


def group_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, list of words) to (id, word, its positions in the list), each word of a row once."""
    for batch in batches:
        for start in range(0, batch.num_rows, GROUPED):
            part = batch.slice(start, GROUPED)
            lists = part.column(1)
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            words = lists.flatten().dictionary_encode()
            codes = words.indices.to_numpy().astype(np.int64)
            rows = np.repeat(np.arange(len(sizes)), sizes)
            places = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            keys = rows * max(len(words.dictionary), 1) + codes
            order = np.argsort(keys, kind="stable")
            begins = np.flatnonzero(np.diff(keys[order], prepend=-1))
            first = order[begins]
            positions = pa.ListArray.from_arrays(
                pa.array(np.append(begins, len(keys)).astype(np.int32)), pa.array(places[order].astype(np.int32))
            )
            ids = part.column(0).take(pa.array(rows[first]))
            yield pa.RecordBatch.from_arrays([ids, words.dictionary.take(pa.array(codes[first])), positions], ["doc_id", "term", "positions"])


def build_postings(
    df: DataFrame, id_col: str, text_col: str, stop_words: Sequence[str] = STOP_WORDS, stemmed: bool = False
) -> DataFrame:
    """All postings of a table of texts. Stop words are left out but keep their positions.

    The words of a text are grouped inside its batch of rows, so nothing is shuffled.
    """
    words = tokens(F.col(text_col))
    # no other word has a suffix that goes
    stem = lambda t: F.when(t.endswith("s") | t.endswith("ing") | t.endswith("ed"), light_stem(t)).otherwise(t)
    words = F.transform(words, stem) if stemmed else words
    rows = df.select(F.col(id_col).alias("doc_id"), words.alias("words"))
    schema = StructType([rows.schema["doc_id"], *StructType.fromDDL("term string, positions array<int>").fields])
    postings = rows.mapInArrow(group_words, schema)
    return postings.where(~F.col("term").isin(list(stop_words))) if stop_words else postings


def scan_postings(
    df: DataFrame, id_col: str, text_col: str, stop_words: Sequence[str] = STOP_WORDS, stemmed: bool = False
) -> DataFrame:
    """Postings for a single search without a stored index: one row per word, nothing grouped yet.

    A search filters its own words before the one shuffle it needs.
    """
    words = df.select(F.col(id_col).alias("doc_id"), F.posexplode(tokens(F.col(text_col))).alias("pos", "term"))
    words = words.where(~F.col("term").isin(list(stop_words))) if stop_words else words
    words = words.withColumn("term", light_stem(F.col("term"))) if stemmed else words
    return words.select("doc_id", "term", F.array("pos").alias("positions"))


#: Rows of one word go to so many tasks, since a text may be little more than a word that every text has.
SPREAD = 16


def spread(key: str) -> Column:
    """A number below ``SPREAD`` by the hash of another column."""
    return F.pmod(F.xxhash64(key), F.lit(SPREAD))


def write_index(postings: DataFrame, path: str) -> None:
    """Store postings in files in term order: a search then reads the pages of its own words.

    Rows are dealt by hashes, not by ranges, whose bounds would have to be found first by tokenizing every text once more.
    """
    postings.repartition("term", spread("doc_id")).sortWithinPartitions("term", "doc_id").write.mode(
        "overwrite"
    ).parquet(path)


def _words(expr) -> list:
    """The distinct words of a tree, with whether their positions are needed."""
    if isinstance(expr, (Term, AnyOf)):
        return [expr]
    if isinstance(expr, Phrase):
        return list(expr.words)
    if isinstance(expr, Near):
        return [expr.left, expr.right]
    if isinstance(expr, Not):
        return _words(expr.part)
    return [w for part in expr.parts for w in _words(part)]


def _positional(expr) -> set:
    if isinstance(expr, (Phrase, Near)):
        return set(_words(expr))
    if isinstance(expr, Not):
        return _positional(expr.part)
    return {w for part in getattr(expr, "parts", ()) for w in _positional(part)}


def _shift(positions: Column, by: int) -> Column:
    return F.transform(positions, lambda p: p + by)


def _condition(expr, column) -> Column:
    if isinstance(expr, (Term, AnyOf)):
        return column(expr, False)
    if isinstance(expr, Phrase):
        gaps = expr.gaps or (1,) * (len(expr.words) - 1)
        reached = column(expr.words[0], True)
        for word, gap in zip(expr.words[1:], gaps, strict=True):
            reached = F.array_intersect(_shift(reached, gap), column(word, True))
        return F.size(reached) > 0
    if isinstance(expr, Near):
        around = F.flatten(
            F.transform(
                column(expr.left, True),
                lambda p: F.filter(F.sequence(p - expr.distance, p + expr.distance), lambda q: q != p),
            )
        )
        return F.arrays_overlap(around, column(expr.right, True))
    if isinstance(expr, Not):
        return ~_condition(expr.part, column)
    conditions = [_condition(part, column) for part in expr.parts]
    joined = conditions[0]
    for c in conditions[1:]:
        joined = joined & c if isinstance(expr, And) else joined | c
    return joined


def _holds_without_words(expr) -> bool:
    if isinstance(expr, Not):
        return not _holds_without_words(expr.part)
    if isinstance(expr, And):
        return all(map(_holds_without_words, expr.parts))
    if isinstance(expr, Or):
        return any(map(_holds_without_words, expr.parts))
    return False


def _grouped(postings: DataFrame, words: Sequence, positional: set) -> DataFrame:
    """Per document of the given words' postings: a flag, or the positions, of each word."""
    wanted = words[0].matches()
    for word in words[1:]:
        wanted = wanted | word.matches()
    aggregates = []
    for i, word in enumerate(words):
        if word in positional:
            found = F.collect_list(F.when(word.matches(), F.col("positions")))
            aggregates.append(F.flatten(found).alias(f"w{i}"))
        else:
            aggregates.append(F.max(word.matches()).alias(f"w{i}"))
    return postings.where(wanted).groupBy("doc_id").agg(*aggregates)


def search(postings: DataFrame, expr, documents: DataFrame | None = None) -> DataFrame:
    """doc_id of every document for which the tree holds.

    A tree that holds for a document with none of its words (a bare NOT) needs ``documents`` (doc_id).
    """
    words = list(dict.fromkeys(_words(expr)))
    positional = _positional(expr)
    grouped = _grouped(postings, words, positional)

    def column(word, as_positions: bool) -> Column:
        c = F.col(f"w{words.index(word)}")
        return F.size(c) > 0 if word in positional and not as_positions else c

    hits = grouped.where(_condition(expr, column)).select("doc_id")
    if not _holds_without_words(expr):
        return hits
    if documents is None:
        raise ValueError("this search also holds for documents without any of its words; pass the documents")
    untouched = documents.select("doc_id").join(grouped.select("doc_id"), "doc_id", "left_anti")
    return hits.unionByName(untouched)


def rank_near(postings: DataFrame, left: Term, right: Term, window: int, k: int) -> DataFrame:
    """Top ``k`` documents by closeness of two words: the sum of 1/distance over pairs within ``window``.

    The formula is this library's own. Pairs are counted one distance at a time on the position lists, so a
    document costs window times its hits, not the product of them.
    """
    grouped = _grouped(postings, [left, right], {left, right})

    def pairs_at(distance: int) -> Column:
        ahead = F.size(F.array_intersect(_shift(F.col("w0"), distance), F.col("w1")))
        behind = F.size(F.array_intersect(_shift(F.col("w0"), -distance), F.col("w1")))
        return (ahead + behind) / F.lit(float(distance))

    score = pairs_at(1)
    for distance in range(2, window + 1):
        score = score + pairs_at(distance)
    ranked = grouped.select("doc_id", F.round(score, 6).alias("score")).where(F.col("score") > 0)
    return ranked.orderBy(F.desc("score"), "doc_id").limit(k)


def term_statistics(postings: DataFrame) -> DataFrame:
    """Document frequency and total frequency per term."""
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("doc_freq"), F.sum(F.size("positions")).alias("total_freq")
    )


def missing_in_range(index: DataFrame, since: str, until: str, ids: DataFrame | None = None) -> DataFrame:
    """Documents without an abstract created or updated between two days, both included."""
    first, last = F.lit(since).cast("date"), F.lit(until).cast("date")
    inside = F.col("created_date").cast("date").between(first, last) | F.col("updated_date").cast("date").between(
        first, last
    )
    hits = index.where(F.col("abstract").isNull() & inside)
    return hits if ids is None else hits.join(ids, "id", "left_semi")
