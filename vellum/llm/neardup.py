"""Near-duplicate classes: consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard.

A text is a weighted set of five-word shingles; a weight is the shingle's count times the mean idf of its words. Document
frequencies are counted over all documents in a table of hashed words of fixed size, so the table can be sent to every
task. (A shingle's own document frequency is almost always one, and would cut near copies off from large groups.) Improved
consistent weighted sampling draws ``samples`` (shingle, level) pairs per text that agree between two texts with the
probability of their weighted Jaccard similarity; bands of samples are the bucket keys.

Equal texts are one class before anything else. Links between different texts are found in two passes over the buckets:
first every text against the smallest id of each of its buckets, then, in buckets that still hold several classes, all
texts of different classes. Each text comes there once and the candidates are verified on the spot, so that not even a
large group of merely similar texts makes pairs that have to be moved. A pair is a candidate if at least ``agree`` of its samples
are equal, which all but 4 in a million pairs of just sufficient similarity are and few pairs that only share a passage, and if
the total weights allow the similarity at all. Candidate pairs are verified on the whole texts, in the second pass those whose
classes no link of the group has joined yet. Classes are the connected components of the verified links.

No group is collected: buckets are aggregated to their smallest id, hot leaders are salted. A hot bucket of one class and
at most ``block`` other texts is cut into blocks, and the other texts go to each of them. A hot bucket of more other texts
is dealt anew by the rarest shingles of each text that hold more than 1 - ``similarity`` of its weight: two texts that are
similar enough always share one of those, texts that share only a long template do not. Groups of such a shingle that are
still hot and mixed are cut into blocks that meet pairwise.

Null texts count as empty. Equal texts, empty ones too, are always in one class; a text without words is in no other. A
text of fewer than five words is one shingle. Repeated rows give repeated results; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import slices, text_slices, texts, write_shared
from vellum.llm.shingles import U, buckets, mix, weighted_sets, words


#: Room for rounding when total weights are compared.
SLACK = 1e-6


@dataclass(frozen=True)
class NearDupConfig:
    """similarity: least weighted Jaccard of a link. table: buckets of hashed words for document frequencies."""

    similarity: float = 0.8
    words: int = 5
    bands: int = 16
    rows: int = 4
    table: int = 1 << 18
    variates: int = 1 << 14
    agree: int = 36
    salt: int = 256
    block: int = 512
    sent: int = 1 << 20
    seed: int = 5

    @property
    def samples(self) -> int:
        return self.bands * self.rows


def document_frequencies(docs: DataFrame, config: NearDupConfig) -> np.ndarray:
    """Smoothed idf of every bucket of hashed words, over all documents. Its size is fixed by the configuration."""
    table = config.table

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(table, dtype=np.int64), 0
        last = np.zeros(table, dtype=np.int32)  # the last word of a text in each bucket stands for it
        for batch in batches:
            for _, rows in text_slices(batch):
                hashes, counts = words(rows)
                at, places, begin = buckets(hashes, table), np.arange(counts.max(), dtype=np.int32), 0
                for size in counts.tolist():
                    own, place = at[begin : begin + size], places[:size]
                    last[own] = place
                    df[own[last[own] == place]] += 1
                    begin += size
                n += len(rows)
        if n:
            at = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(df[at], n), pa.int64())], ["bucket", "n"]
            )

    sums = docs.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    at, n = sums["bucket"].to_numpy(), sums["n"].to_numpy(dtype=np.float64)
    df, total = np.zeros(table), float(n[at < 0].sum())
    df[at[at >= 0]] = n[at >= 0]
    return np.log((1 + total) / (1 + df)) + 1


class Sampler:
    """Improved consistent weighted sampling with tabulated variates.

    A shingle's hash picks one row of the table of gamma and uniform variates, so equal shingles draw alike in every text.
    """

    def __init__(self, config: NearDupConfig):
        rng = np.random.default_rng(config.seed)
        size = (config.variates, config.samples)
        self.r = rng.gamma(2, 1, size).astype(np.float32)
        self.log_c = np.log(rng.gamma(2, 1, size)).astype(np.float32)
        self.beta = rng.random(size).astype(np.float32)
        self.k = np.arange(config.samples)
        self.salts = mix(np.arange(1, config.samples + 1, dtype=U))
        self.bands, self.rows = config.bands, config.rows

    def draw(self, hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Samples (32 bits each) and band keys of weighted sets, a row for each; ``starts`` says where the sets begin, none is empty."""
        starts = np.zeros(1, dtype=np.int64) if starts is None else starts
        row = (hashes % U(len(self.r))).astype(np.int64)
        log_w = np.log(weights).astype(np.float32)
        r, a = self.r.take(row, axis=0), self.beta.take(row, axis=0)
        level = log_w[:, None] / r
        level += a
        np.floor(level, out=level)
        a -= level
        a -= 1
        a *= r
        a += self.log_c.take(row, axis=0)
        sets = zip(starts.tolist(), [*starts[1:].tolist(), len(hashes)], strict=True)
        best = np.stack([a[lo:hi].argmin(axis=0) + lo for lo, hi in sets])
        values = mix(hashes[best] ^ self.salts ^ (level[best, self.k].astype(np.int64).astype(U) * U(0x2545F4914F6CDD1D)))
        keys = np.arange(1, self.bands + 1, dtype=U)
        for column in np.moveaxis(values.reshape(-1, self.bands, self.rows), 2, 0):
            keys = mix(keys * U(31) ^ column)
        return (values & U(0xFFFFFFFF)).astype(np.uint32).view(np.int32), keys.view(np.int64)

    def draw_all(self, hashes: np.ndarray, weights: np.ndarray, sizes: np.ndarray, most: int = 1 << 12) -> tuple[np.ndarray, np.ndarray]:
        """``draw`` for the texts with words among all of a slice, of ``sizes`` shingles; about ``most`` shingles at a time stay in the cache."""
        sizes = sizes[sizes > 0]
        ends, found = np.cumsum(sizes), []
        for lo, hi in slices(sizes.tolist(), most):
            first = int(ends[lo] - sizes[lo])
            found.append(self.draw(hashes[first : ends[hi - 1]], weights[first : ends[hi - 1]], ends[lo:hi] - sizes[lo:hi] - first))
        if not found:
            return np.empty((0, len(self.k)), dtype=np.int32), np.empty((0, self.bands), dtype=np.int64)
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def signatures(docs: DataFrame, idf: np.ndarray, config: NearDupConfig) -> DataFrame:
    """(id, h1, h2, weight, samples, keys): the text's 128-bit hash and total weight, its samples and band keys (empty without words)."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)  # config.table numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, idf = Sampler(config), shared.value
        for batch in batches:
            for ids, rows in text_slices(batch):
                doc, h, w = weighted_sets(rows, config.words, idf)
                at = np.searchsorted(doc, np.arange(len(rows) + 1))
                samples, keys = sampler.draw_all(h, w, np.diff(at))
                ends = np.append(0, np.cumsum(np.diff(at) > 0)).astype(np.int32)
                digest = np.array([np.frombuffer(hashlib.blake2b(t.encode(), digest_size=16).digest(), np.int64) for t in rows])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, batch.schema.field("id").type),
                        pa.array(digest[:, 0]),
                        pa.array(digest[:, 1]),
                        pa.array(np.diff(np.concatenate([[0.0], np.cumsum(w)])[at])),
                        pa.ListArray.from_arrays(ends * config.samples, samples.ravel()),
                        pa.ListArray.from_arrays(ends * config.bands, keys.ravel()),
                    ],
                    ["id", "h1", "h2", "weight", "samples", "keys"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, h1 long, h2 long, weight double, samples array<int>, keys array<long>")


def agreeing(a: str, b: str) -> Column:
    """How many samples two texts share."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)


def comparable(a: str, b: str, config: NearDupConfig) -> Column:
    """Whether two total weights allow the similarity: it cannot exceed the smaller over the larger one."""
    return F.least(a, b) >= (config.similarity - SLACK) * F.greatest(a, b)


def verified(pairs: DataFrame, needed: DataFrame, idf: np.ndarray, config: NearDupConfig) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar enough; a hot ``a`` is spread over several salted groups."""
    hot = pairs.groupBy("a").agg((F.count("*") / config.salt).cast("int").alias("salts"))
    salted = pairs.join(hot, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts") + 1).cast("int"))
    left = hot.join(needed, hot["a"] == needed["id"]).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("salts"))).alias("salt"), F.lit(0).alias("kind"), F.col("a").alias("id"), "text"
    )
    right = salted.join(needed, salted["b"] == needed["id"]).select("a", "salt", F.lit(1).alias("kind"), "id", "text")
    both = left.unionByName(right)
    both = both.repartition(F.col("a"), F.col("salt")).sortWithinPartitions("a", "salt", "kind", "id")
    shared = pairs.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, None
        for batch in batches:
            sizes = [len(t) for t in (text or "" for text in batch.column("text").to_pylist())]
            for lo, hi in slices(sizes, 1 << 20):
                part = batch.slice(lo, hi - lo).to_pydict()
                doc, h, w = weighted_sets(part["text"], config.words, shared.value)
                at = np.searchsorted(doc, np.arange(hi - lo + 1))
                a, b, s = [], [], []
                for i, kind in enumerate(part["kind"]):
                    set_i = h[at[i] : at[i + 1]], w[at[i] : at[i + 1]]
                    if kind == 0:
                        leader, own = part["a"][i], set_i
                        continue
                    similarity = weighted_jaccard(own, set_i)
                    if leader == part["a"][i] and similarity >= config.similarity:
                        a.append(leader)
                        b.append(part["id"][i])
                        s.append(similarity)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, batch.schema.field("a").type), pa.array(b, batch.schema.field("id").type), pa.array(s, pa.float64())],
                    ["a", "b", "similarity"],
                )

    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(run, f"a {kind}, b {kind}, similarity double")


def weighted_jaccard(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the smaller weights over the sum of the larger ones; the hashes of each set are sorted."""
    at = np.searchsorted(y[0], x[0])
    at[at == len(y[0])] = 0
    both = y[0][at] == x[0] if len(y[0]) else np.zeros(len(x[0]), dtype=bool)
    least = float(np.minimum(x[1][both], y[1][at[both]]).sum()) if len(y[0]) else 0.0
    total = float(x[1].sum() + y[1].sum()) - least
    return least / total if total else 0.0


def components(links: DataFrame) -> DataFrame:
    """(id, root) of every linked id: the smallest id of its connected component.

    Alternating large-star and small-star steps; the edges are written to the shared folder after each round.
    """
    edges = write_shared(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u <> v").distinct()
        )
        edges = write_shared(small, "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        seen = state


def grouped(batches: Iterator[pa.RecordBatch], by: tuple[str, ...]) -> Iterator[pa.Table]:
    """The groups of sorted rows, also where a group goes on in the next batch."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        mark = np.stack([table.column(c).to_numpy() for c in by])
        starts = np.flatnonzero((mark[:, 1:] != mark[:, :-1]).any(axis=0)) + 1
        if held and tuple(held[-1].column(c)[-1].as_py() for c in by) != tuple(mark[:, 0].tolist()):
            yield pa.concat_tables(held)
            held = []
        for lo, hi in zip([0, *starts[:-1]], starts, strict=False):
            yield pa.concat_tables([*held, table.slice(lo, hi - lo)])
            held = []
        held.append(table.slice(starts[-1] if len(starts) else 0))
    if held:
        yield pa.concat_tables(held)


def candidates(group: pa.Table, config: NearDupConfig) -> Iterator[tuple[int, np.ndarray]]:
    """(row, rows after it) of a group that may be similar and are in different classes and, if the group is a pair of blocks, in different ones."""
    root, own, weight = (group.column(c).to_numpy() for c in ("root", "own", "weight"))
    if len(root) < 2 or (root == root[0]).all():
        return
    s = group.column("samples").combine_chunks().flatten().to_numpy().reshape(len(root), -1)
    apart = group.column("i")[0].as_py() != group.column("j")[0].as_py()
    for x in range(len(root) - 1):
        hit = ((s[x + 1 :] == s[x]).sum(axis=1) >= config.agree) & (root[x + 1 :] != root[x])
        other = weight[x + 1 :]
        hit &= np.minimum(other, weight[x]) >= (config.similarity - SLACK) * np.maximum(other, weight[x])
        if apart:
            hit &= own[x + 1 :] != own[x]
        if hit.any():
            yield x, np.flatnonzero(hit) + x + 1


BLOCK = ("key", "i", "j")


def mixed_buckets(member: DataFrame) -> DataFrame:
    """(key, n, major, others) of the buckets with several classes: texts, the most frequent class, texts of other ones."""
    sizes = member.groupBy("key", "root").agg(F.count("*").alias("m"))
    found = sizes.groupBy("key").agg(F.sum("m").alias("n"), F.max(F.struct("m", "root")).alias("top"), F.count("*").alias("roots"))
    found = found.filter("roots > 1")
    return found.select("key", "n", F.col("top.root").alias("major"), (F.col("n") - F.col("top.m")).alias("others"))


def placed(members: DataFrame, config: NearDupConfig) -> DataFrame:
    """(key, i, j, own, id, root, weight, samples): the groups of texts to compare; none exceeds about two blocks.

    ``members`` holds (key, n, id, root, weight, samples), and (major, others) if known. A bucket of more than ``block`` texts
    is cut into blocks by the texts' hashes. With at most ``block`` texts outside its major class, those meet each block of
    the class; else each pair of blocks is a group of its own.
    """
    blocks = F.ceil(F.col("n") / config.block).cast("int")
    own = F.pmod(F.xxhash64("id"), blocks).cast("int")
    cut = members.withColumn("blocks", blocks).withColumn("own", own)
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    i, j = F.least("own", "other"), F.greatest("own", "other")
    if "major" in members.columns:
        few = F.col("others") <= config.block
        every = F.when(few & (F.col("root") == F.col("major")), F.array("own")).otherwise(every)
        i, j = F.when(few, F.col("other")).otherwise(i), F.when(few, F.col("other")).otherwise(j)
    cut = cut.withColumn("other", F.explode(every))
    return cut.select("key", i.alias("i"), j.alias("j"), "own", "id", "root", "weight", "samples")


def shingle_frequencies(needed: DataFrame, idf: np.ndarray, config: NearDupConfig) -> np.ndarray:
    """In how many texts the shingles of each of ``table`` buckets of hashes occur."""
    shared, table = needed.sparkSession.sparkContext.broadcast(idf), config.table

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(table, dtype=np.int64)
        for batch in batches:
            for _, rows in text_slices(batch):
                seen += np.bincount(buckets(weighted_sets(rows, config.words, shared.value)[1], table), minlength=table)
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(seen[at], pa.int64())], ["bucket", "n"])

    sums = needed.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(table, dtype=np.int64)
    out[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return out


def rarest(h: np.ndarray, w: np.ndarray, frequency: np.ndarray, config: NearDupConfig) -> np.ndarray:
    """The rarest shingles of a text that leave less than ``similarity`` of its weight to the others.

    All texts take them in one order. Of two texts, take the one whose last such shingle comes first: if they share none of
    them, what they share is among its other shingles, which is too little.
    """
    order = np.lexsort((h, frequency[buckets(h, len(frequency))]))
    reached = np.cumsum(w[order])
    enough = np.searchsorted(reached, (1 - config.similarity + SLACK) * reached[-1], side="right") if len(h) else 0
    return h[order[: enough + 1]]


def rare_keys(needed: DataFrame, idf: np.ndarray, config: NearDupConfig) -> DataFrame:
    """(id, key): the rarest shingles of every text."""
    spark = needed.sparkSession
    shared = spark.sparkContext.broadcast((idf, shingle_frequencies(needed, idf, config)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, rows in text_slices(batch):
                doc, h, w = weighted_sets(rows, config.words, shared.value[0])
                at = np.searchsorted(doc, np.arange(len(rows) + 1))
                keys = [rarest(h[lo:hi], w[lo:hi], shared.value[1], config) for lo, hi in zip(at[:-1], at[1:], strict=True)]
                who = pa.array(ids, batch.schema.field("id").type).take(pa.array(np.repeat(np.arange(len(ids)), [len(k) for k in keys])))
                yield pa.RecordBatch.from_arrays([who, pa.array(np.concatenate(keys).view(np.int64))], ["id", "key"])

    return needed.mapInArrow(run, f"id {needed.schema['id'].dataType.simpleString()}, key long")


def mixed_members(members: DataFrame, config: NearDupConfig) -> DataFrame:
    """Texts of buckets with several classes that have a candidate there: (key, i, j, own, id, root, weight, samples)."""
    cut = placed(members, config)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema.fields)
    cut = cut.repartition(*BLOCK).sortWithinPartitions(*BLOCK, "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, BLOCK):
            taken = np.zeros(len(group), dtype=bool)
            for x, rows in candidates(group, config):
                taken[x] = True
                taken[rows] = True
            if taken.any():
                yield from group.filter(pa.array(taken)).to_batches()

    return cut.mapInArrow(run, kinds)


def mixed_links(members: DataFrame, needed: DataFrame, idf: np.ndarray, config: NearDupConfig) -> DataFrame:
    """Verified links (a, b, similarity) that join different classes of a bucket, in each group one less than classes at most.

    Every text comes once to each of its groups.
    """
    rows = members.join(needed, "id").repartition(*BLOCK).sortWithinPartitions(*BLOCK, "id")
    shared = members.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, BLOCK):
            texts = group.column("text").to_pylist()
            sets: list[tuple[np.ndarray, np.ndarray]] = []
            for lo, hi in slices([len(t) for t in texts], 1 << 20):
                doc, h, w = weighted_sets(texts[lo:hi], config.words, shared.value)
                at = np.searchsorted(doc, np.arange(hi - lo + 1))
                sets += [(h[p:q], w[p:q]) for p, q in zip(at[:-1], at[1:], strict=True)]
            ids, a, b, s = group.column("id").to_pylist(), [], [], []
            roots = group.column("root").to_pylist()
            above = {r: r for r in roots}  # classes that the group's links have joined so far

            def top(r):
                while above[r] != r:
                    above[r] = r = above[above[r]]
                return r

            for x, others in candidates(group, config):
                for y in others.tolist():
                    p, q = top(roots[x]), top(roots[y])
                    if p == q:
                        continue
                    similarity = weighted_jaccard(sets[x], sets[y])
                    if similarity >= config.similarity:
                        above[q] = p
                        a.append(ids[x])
                        b.append(ids[y])
                        s.append(similarity)
            if a:
                kind = group.schema.field("id").type
                yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind), pa.array(s, pa.float64())], ["a", "b", "similarity"])

    kind = members.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"a {kind}, b {kind}, similarity double")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: NearDupConfig | None = None
) -> DataFrame:
    """(doc_id, class_id) of every row; class_id is the smallest id of the class."""
    config = config or NearDupConfig()
    rows = texts(docs, id_col, text_col)
    idf = document_frequencies(rows, config)
    sig = write_shared(signatures(rows, idf, config), "signatures")
    copies = sig.groupBy("h1", "h2").agg(F.min("id").alias("rep"))
    different = sig.join(copies, (sig["h1"] == copies["h1"]) & (sig["h2"] == copies["h2"]) & (sig["id"] == copies["rep"]))
    different = write_shared(different.select(sig["id"], sig["weight"], sig["samples"], sig["keys"]).dropDuplicates(["id"]), "different")

    member = different.select("id", F.explode("keys").alias("key"))
    leaders = member.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).filter("n > 1")
    star = member.join(leaders, "key").filter("id <> a").select("a", F.col("id").alias("b")).distinct()
    of_a, of_b = (different.select(*[F.col(c).alias(n) for c, n in (("id", x), ("weight", f"weight_{x}"), ("samples", f"samples_{x}"))]) for x in "ab")
    star = star.join(of_b, "b").join(of_a, "a").filter(comparable("weight_a", "weight_b", config))
    star = star.filter(agreeing("samples_a", "samples_b") >= config.agree).select("a", "b")
    star = write_shared(star, "star")
    texts_of_star = needed_texts(rows, star.select(F.explode(F.array("a", "b")).alias("id")), config)
    links = write_shared(verified(star, texts_of_star, idf, config), "links")

    roots = components(links)
    member = member.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    member = write_shared(member.select("key", "id", "root"), "member")
    mixed = write_shared(mixed_buckets(member), "mixed")
    facts = different.select("id", "weight", "samples")
    near = (F.col("n") <= config.block) | (F.col("others") <= config.block)
    rest = write_shared(mixed_members(member.join(mixed.filter(near), "key").join(facts, "id"), config), "rest")
    if not mixed.filter(~near).isEmpty():
        hot = write_shared(member.join(mixed.filter(~near), "key", "left_semi").select("id", "root").distinct(), "hot")
        rare = rare_keys(needed_texts(rows, hot.select("id"), config), idf, config)
        rare = write_shared(rare.join(hot, "id"), "rare")
        rare = rare.join(mixed_buckets(rare), "key").join(facts, "id")
        rest = rest.unionByName(write_shared(mixed_members(rare, config), "rest"))
    more = write_shared(mixed_links(rest, needed_texts(rows, rest.select("id"), config), idf, config), "links")

    roots = components(links.union(more))
    classes = copies.join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    classes = classes.select("h1", "h2", F.coalesce("root", "rep").alias("class_id"))
    return sig.select("id", "h1", "h2").join(classes, ["h1", "h2"]).select(F.col("id").alias("doc_id"), "class_id")


def needed_texts(rows: DataFrame, ids: DataFrame, config: NearDupConfig) -> DataFrame:
    """One (id, text) for each of the ids, written once. Up to ``sent`` ids are broadcast, so that no other text moves."""
    ids = write_shared(ids.distinct(), "ids")
    ids = F.broadcast(ids) if ids.count() <= config.sent else ids
    return write_shared(rows.join(ids, "id", "left_semi").dropDuplicates(["id"]), "texts")
