"""A stored text index that grows by segments, with a dictionary of its terms.

Each added table of texts is one segment: postings in buckets by the hash of the term, sorted by term, a dictionary of the terms
with their stems and frequencies, the trigrams of the dictionary's terms, and the list of its documents. A document that
comes again, or is removed, hides what older segments have of it; nothing old is rewritten. Segments of like size are merged
by ranges of terms. A manifest names the segments, and readers see the old list or the new one.

Words with a wildcard are looked up in the dictionary by the trigrams of their letters; stemmed words by their stem. Only the buckets
of the terms found are opened. Stop words are indexed.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vellum.functions.stemming import english_stem
from vellum.functions.text import MAX_TOKEN_LENGTH
from vellum.operators.search import AnyOf, Near, Not, Or, Phrase, Term, _condition, _holds_without_words, _positional, _shift, _words, build_postings, spread
from vellum.session import cut_lineage
from vellum.sources.manifest import Manifest, Version

TERM_ENDS = "^", "$"


def _trigrams(text: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text) - 2), lambda i: F.substring(text, i, F.lit(3)))


def required_trigrams(pattern: str) -> list[str]:
    """Trigrams that every term matching a pattern with ``*`` has, its ends marked."""
    pieces = f"{TERM_ENDS[0]}{pattern}{TERM_ENDS[1]}".split("*")
    return sorted({piece[i : i + 3] for piece in pieces for i in range(len(piece) - 2)})


def _like(pattern: str) -> str:
    return re.sub(r"([\\%_])", r"\\\1", pattern).replace("*", "%")


class TextIndex:
    """The index below ``root``. ``buckets`` is fixed by the first segment; ``fan`` segments of like size become one."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, fan: int = 4):
        self.spark, self.root, self.fan = spark, root, fan
        self.manifest = Manifest(spark, root)
        latest = self.manifest.latest()
        self.buckets = latest.facts["buckets"] if latest else buckets
        self.id_type = latest.facts["id_type"] if latest else None

    # -- writing -------------------------------------------------------------------------------------------------

    def add(self, texts: DataFrame, id_col: str, text_col: str) -> None:
        """Index texts (one row per id) as a new segment; they replace older texts with the same ids."""
        rows = texts.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
        self._add(build_postings(rows, "doc_id", "text", stop_words=()), rows.select("doc_id"))

    def remove(self, ids: DataFrame, id_col: str) -> None:
        """Hide documents."""
        gone = ids.select(F.col(id_col).alias("doc_id")).distinct()
        nothing = StructType.fromDDL("term string, positions array<int>")
        self._add(gone.where(F.lit(False)).select("doc_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in nothing]), gone)

    def _add(self, postings: DataFrame, documents: DataFrame) -> None:
        latest = self.manifest.latest()
        if latest is None:
            self.id_type = documents.schema["doc_id"].dataType.simpleString()
            latest = Version(0, None, [], {"buckets": self.buckets, "id_type": self.id_type})
        entry = self._write(postings, documents)
        following = Version(latest.number + 1, None, [*latest.entries, entry], latest.facts)
        self.manifest.commit(following)
        due = self._due(following.entries)
        if due:
            self.merge(due)

    def _write(self, postings: DataFrame, documents: DataFrame) -> dict:
        """A segment's folder: postings, dictionary, trigrams, documents."""
        folder = f"segment-{uuid.uuid4().hex[:12]}"
        path = f"{self.root}/data/{folder}"
        dealt = postings.withColumn("_bucket", self._bucket(F.col("term")))
        # a bucket goes to several tasks by document, so a word that every text has is not one task; ranges would tokenize twice
        parts = -(-int(self.spark.conf.get("spark.sql.shuffle.partitions")) // self.buckets)
        part = F.col("_bucket") * parts + F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int")
        dealt = dealt.repartitionById(self.buckets * parts, part).sortWithinPartitions("_bucket", "term", "doc_id")
        dealt.write.partitionBy("_bucket").parquet(f"{path}/postings")
        stored = self._segment(folder)
        terms = stored.groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"), F.sum(F.size("positions")).alias("total_freq"))
        terms = terms.withColumn("stem", english_stem(F.col("term")))
        terms.sortWithinPartitions("term").write.parquet(f"{path}/terms")
        marked = F.concat(F.lit(TERM_ENDS[0]), F.col("term"), F.lit(TERM_ENDS[1]))
        grams = self._terms([folder]).select(F.explode(F.array_distinct(_trigrams(marked))).alias("gram"), "term")
        grams.repartition("gram", spread("term")).sortWithinPartitions("gram", "term").write.parquet(f"{path}/grams")
        documents.write.parquet(f"{path}/documents")
        held = stored.select("_bucket").distinct().collect()
        size = self._documents([folder]).count()
        return {"folder": folder, "buckets": sorted(r[0] for r in held), "documents": size}

    def _due(self, entries: list[dict]) -> int:
        """How many of the newest segments are of like size, once there are ``fan`` of them."""
        tier = [int(math.log(max(e["documents"], 1), self.fan)) for e in entries]
        start = len(entries) - 1
        while start > 0 and tier[start - 1] <= max(tier[start:]):
            start -= 1
        return len(entries) - start if len(entries) - start >= self.fan else 0

    def merge(self, newest: int | None = None) -> None:
        """Make one segment of the newest so many, or of all."""
        version = self.manifest.latest()
        if version is None:
            return
        start = 0 if newest is None else max(0, len(version.entries) - newest)
        kept, merged = version.entries[:start], version.entries[start:]
        if len(merged) > 1:
            documents = self._documents([e["folder"] for e in merged]).distinct()
            entry = self._write(self._live(merged, None), documents)
            self.manifest.commit(Version(version.number + 1, None, [*kept, entry], version.facts))

    # -- reading -------------------------------------------------------------------------------------------------

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def _segment(self, folder: str, buckets: Sequence[int] | None = None) -> DataFrame:
        root = f"{self.root}/data/{folder}/postings"
        reader = self.spark.read.schema(f"doc_id {self.id_type}, term string, positions array<int>, _bucket int").option("basePath", root)
        return reader.parquet(*([root] if buckets is None else [f"{root}/_bucket={b}" for b in buckets]))

    def _terms(self, folders: list[str]) -> DataFrame:
        schema = "term string, doc_freq bigint, total_freq bigint, stem string"
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/data/{f}/terms" for f in folders])

    def _documents(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(f"doc_id {self.id_type}").parquet(*[f"{self.root}/data/{f}/documents" for f in folders])

    def _entries(self) -> list[dict]:
        latest = self.manifest.latest()
        return latest.entries if latest else []

    def _live(self, entries: list[dict], buckets: set[int] | None) -> DataFrame:
        """Postings of some segments, without those of documents that a later one of them has or removes."""
        merged = None
        for number, e in enumerate(entries):
            wanted = None if buckets is None else sorted(buckets.intersection(e["buckets"]))
            if wanted == [] or not e["buckets"]:
                continue
            part = self._segment(e["folder"], wanted).drop("_bucket").withColumn("_segment", F.lit(number))
            merged = part if merged is None else merged.unionByName(part)
        if merged is None:
            return self.spark.createDataFrame([], StructType.fromDDL(f"doc_id {self.id_type or 'string'}, term string, positions array<int>"))
        later = None
        for number, e in enumerate(entries[1:], 1):
            part = self._documents([e["folder"]]).withColumn("_last", F.lit(number))
            later = part if later is None else later.unionByName(part)
        if later is not None:
            later = later.groupBy("doc_id").agg(F.max("_last").alias("_last"))
            merged = merged.join(later, "doc_id", "left").where(F.coalesce(F.col("_segment") >= F.col("_last"), F.lit(True)))
        return merged.select("doc_id", "term", "positions")

    def postings(self) -> DataFrame:
        """All postings in force."""
        return self._live(self._entries(), None)

    def dictionary(self) -> DataFrame:
        """(term, stem, doc_freq, total_freq) of the terms in force. With one segment this is its stored dictionary."""
        entries = self._entries()
        if len(entries) == 1:
            return self._terms([entries[0]["folder"]])
        counts = self.postings().groupBy("term").agg(F.count(F.lit(1)).alias("doc_freq"), F.sum(F.size("positions")).alias("total_freq"))
        return counts.withColumn("stem", english_stem(F.col("term")))

    def matching_terms(self, pattern: str) -> DataFrame:
        """Terms of the dictionary that match a pattern with ``*``: those that have all its trigrams, verified.

        A pattern without three letters in a row, its ends counted, looks at the whole dictionary.
        """
        folders = [e["folder"] for e in self._entries()]
        if not folders:
            return self.spark.createDataFrame([], "term string")
        grams = required_trigrams(pattern)
        if not grams:
            return self._terms(folders).where(F.col("term").like(_like(pattern))).select("term").distinct()
        held = self.spark.read.schema("gram string, term string").parquet(*[f"{self.root}/data/{f}/grams" for f in folders])
        held = held.where(F.col("gram").isin(grams) & F.col("term").like(_like(pattern)))
        return held.groupBy("term").agg(F.count_distinct("gram").alias("n")).where(F.col("n") == len(grams)).select("term")

    def _resolved(self, words: Sequence) -> DataFrame:
        """(word, term): the terms of the dictionary that each word of a search stands for."""
        exact, parts = [], []
        folders = [e["folder"] for e in self._entries()]
        for i, word in enumerate(words):
            for term in word.words if isinstance(word, AnyOf) else (word,):
                text = term.text.lower()
                if "*" in text:
                    parts.append(self.matching_terms(text).select(F.lit(i).alias("word"), "term"))
                elif term.stemmed:
                    stem = english_stem(F.lit(text))
                    parts.append(self._terms(folders).where(F.col("stem") == stem).select(F.lit(i).alias("word"), "term"))
                else:
                    exact.append((i, text))
        found = self.spark.createDataFrame(exact, "word int, term string")
        for part in parts:
            found = found.unionByName(part)
        return cut_lineage(found.distinct(), "words")

    def _grouped(self, words: Sequence, positional: set) -> DataFrame:
        """Per document of the words' postings a flag, or the positions, of each word; opens the buckets of their terms."""
        terms = self._resolved(words)
        buckets = {r[0] for r in terms.select(self._bucket(F.col("term"))).distinct().collect()}
        held = self._live(self._entries(), buckets).join(terms, "term")
        aggregates = []
        for i, word in enumerate(words):
            mine = F.col("word") == i
            flag = F.max(mine) if word not in positional else F.flatten(F.collect_list(F.when(mine, F.col("positions"))))
            aggregates.append(flag.alias(f"w{i}"))
        return held.groupBy("doc_id").agg(*aggregates)

    def search(self, expr, documents: DataFrame | None = None) -> DataFrame:
        """doc_id of every document for which the tree holds; a tree that holds without any of its words needs ``documents``."""
        words = list(dict.fromkeys(_words(expr)))
        positional = _positional(expr)
        grouped = self._grouped(words, positional)

        def column(word, as_positions: bool) -> Column:
            c = F.col(f"w{words.index(word)}")
            return F.size(c) > 0 if word in positional and not as_positions else c

        hits = grouped.where(_condition(expr, column)).select("doc_id")
        if not _holds_without_words(expr):
            return hits
        if documents is None:
            raise ValueError("this search also holds for documents without any of its words; pass the documents")
        return hits.unionByName(documents.select("doc_id").join(grouped.select("doc_id"), "doc_id", "left_anti"))

    def substring(self, documents: DataFrame, id_col: str, text_col: str, wanted: str) -> DataFrame:
        """Documents whose text contains a string: the index gives candidates, whose texts are looked at.

        The string's words are a phrase of which the first may begin and the last may end inside a longer word. Words as long as the
        tokenizer's limit may be pieces of longer runs, so their documents are candidates as well. A string
        without letters or digits, or with one whose lower case depends on its neighbours, is looked for in all texts.
        """
        contains = F.col(text_col).contains(wanted)
        runs = re.findall(r"[^\W_]+", wanted.lower())
        if not runs or "Σ" in wanted or len(wanted.lower()) != len(wanted) or any(len(r) >= MAX_TOKEN_LENGTH for r in runs):
            return documents.where(contains)
        first, last = wanted[0].isalnum(), wanted[-1].isalnum()
        words = [Term(("*" if i == 0 and first else "") + r + ("*" if i == len(runs) - 1 and last else "")) for i, r in enumerate(runs)]
        found = self.search(Phrase(tuple(words)) if len(words) > 1 else words[0])
        cut = self._terms([e["folder"] for e in self._entries()]).where(F.length("term") >= MAX_TOKEN_LENGTH).select("term")
        cut = cut_lineage(cut.distinct(), "cut")
        buckets = {r[0] for r in cut.select(self._bucket(F.col("term"))).distinct().collect()}
        if buckets:
            found = found.unionByName(self._live(self._entries(), buckets).join(cut, "term", "left_semi").select("doc_id"))
        candidates = found.distinct().withColumnRenamed("doc_id", id_col)
        return documents.join(candidates, id_col, "left_semi").where(contains)

    def forget(self, keep: int = 2) -> int:
        return self.manifest.forget(keep)


# -- ranking -------------------------------------------------------------------------------------------------------


def _leaves(expr) -> list:
    """What has places of its own in a tree: words, phrases and pairs; what is negated has none."""
    if isinstance(expr, (Term, AnyOf, Phrase, Near)):
        return [expr]
    if isinstance(expr, Not):
        return []
    return list(dict.fromkeys(leaf for part in expr.parts for leaf in _leaves(part)))


def _places(expr, column) -> Column:
    """The smallest ranges (last, first) in which a leaf holds."""
    if isinstance(expr, (Term, AnyOf)):
        return F.transform(column(expr), lambda p: F.struct(p.alias("last"), p.alias("first")))
    if isinstance(expr, Phrase):
        gaps = expr.gaps or (1,) * (len(expr.words) - 1)
        reached = column(expr.words[0])
        for word, gap in zip(expr.words[1:], gaps, strict=True):
            reached = F.array_intersect(_shift(reached, gap), column(word))
        return F.transform(reached, lambda p: F.struct(p.alias("last"), (p - sum(gaps)).alias("first")))

    def at(d: int) -> Column:
        met = F.array_intersect(_shift(column(expr.left), d), column(expr.right))
        return F.transform(met, lambda q: F.struct(F.greatest(q, q - d).alias("last"), F.least(q, q - d).alias("first")))

    return F.concat(*[at(d) for d in range(-expr.distance, expr.distance + 1) if d])


def _latest_start(expr, leaves: list) -> Column:
    """The latest place from which the tree holds up to the present one, NULL if there is none."""
    if expr in leaves:
        return F.col(f"s{leaves.index(expr)}")
    parts = [_latest_start(part, leaves) for part in expr.parts if _leaves(part)]
    if len(parts) == 1:
        return parts[0]
    if isinstance(expr, Or):
        return F.greatest(*parts)
    present = parts[0].isNotNull()
    for part in parts[1:]:
        present = present & part.isNotNull()
    return F.when(present, F.least(*parts))


def rank_covers(index: TextIndex, expr, k: int) -> DataFrame:
    """Top ``k`` documents by cover density: the sum of 1 / length over the smallest ranges of words in which the tree holds.

    A range is a cover if the tree's words, phrases and pairs inside it satisfy the tree and no smaller range inside it does.
    What is negated decides which documents are ranked, not the covers. Every place is visited once, in order: for each leaf the latest
    place so far is kept, the tree turns those into the latest start of a range that ends here, and the first end of each start is a
    cover. That is linear in the places, which are the hits of one document.
    """
    leaves = _leaves(expr)
    if not leaves:
        raise ValueError("nothing to rank by: the tree has no word that must occur")
    words = list(dict.fromkeys(_words(expr)))
    grouped = index._grouped(words, set(words))

    def column(word, as_positions: bool = True) -> Column:
        c = F.col(f"w{words.index(word)}")
        return c if as_positions else F.size(c) > 0

    hits = grouped.where(_condition(expr, column))

    def events(i: int) -> Column:
        def of(x: Column) -> Column:
            return F.struct(x["last"].alias("last"), *[(x["first"] if j == i else F.lit(None).cast("int")).alias(f"p{j}") for j in range(len(leaves))])

        return F.transform(_places(leaves[i], column), of)

    rows = hits.select("doc_id", F.inline(F.concat(*[events(i) for i in range(len(leaves))]))).groupBy("doc_id", "last").agg(*[F.max(f"p{i}").alias(f"p{i}") for i in range(len(leaves))])
    so_far = Window.partitionBy("doc_id").orderBy("last").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("doc_id", "last", *[F.max(f"p{i}").over(so_far).alias(f"s{i}") for i in range(len(leaves))])
    covers = rows.select("doc_id", "last", _latest_start(expr, leaves).alias("first")).where(F.col("first").isNotNull())
    covers = covers.groupBy("doc_id", "first").agg(F.min("last").alias("last"))
    score = F.sum(1.0 / (F.col("last") - F.col("first") + 1))
    ranked = covers.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_covers"), F.round(score, 6).alias("score"))
    return ranked.orderBy(F.desc("score"), "doc_id").limit(k)
