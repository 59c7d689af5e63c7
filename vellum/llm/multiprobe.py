"""Approximate nearest neighbours by largest inner product: p-stable hashing with multiple probes.

Vectors are brought to one length by an extra component, which turns the largest inner product into the least Euclidean
distance. Each of several tables hashes a vector by rounded-down random projections, (a.x + b) / w, with normally (2-stable)
distributed a. A query visits its own bucket and then the buckets next to it, in the order of estimated success: moving the
j-th hash by one costs the squared distance of the query from that border, and sets of moves are visited by their sum of
costs, cheapest first. The candidates of all visited buckets of all tables are ranked by exact inner products.

How many buckets a query visits is fitted: on a bounded sample the least number is taken with which the sample's own
nearest neighbours are found often enough. A denser table only brings neighbours nearer, which makes them easier to find.
If ``most`` probes of a table do not find them, the tables get fewer hashes, so wider buckets, until they do; with one hash
a query reaches every bucket. A query that meets fewer candidates than it wants then visits every cell of one table's
buckets, which is exact.

Buckets are dealt by hash, hot ones in salted parts, to cells whose number follows the number of index rows: a cell holds
about ``cell`` numbers on average, and a task one cell at a time. A task keeps only the best candidates of each query, so
neither buckets nor pairs are written out.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do null ids. Vectors whose length
differs from the most usual one (the smaller on a tie) are left out too. Equal vectors tie and go by id; of repeated ids one
row is kept, that of the smaller vector. Fewer candidates than wanted are all returned; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.common import write_shared


@dataclass(frozen=True)
class ProbeConfig:
    """wanted: neighbours of a query. recall: share of the sample's neighbours that the fitted probes must find.

    The number of hashes of a table grows with the logarithm of the number of vectors (``hashes_for``) and is lowered where
    ``most`` probes of a table are not enough. cell: components
    that a cell of the index holds on average; cells: the least number of cells (``cells_for``).
    """

    wanted: int = 20
    tables: int = 4
    hashes: int = 0
    width: float = 2.5
    sample: int = 4096
    trials: int = 64
    most: int = 2048
    recall: float = 0.94
    salt: int = 4096
    cells: int = 64
    cell: int = 1 << 22
    held: int = 200_000
    seed: int = 3


class Hasher:
    """The projections of all tables; fixed by dimension, largest norm and seed."""

    def __init__(self, dimension: int, top: float, config: ProbeConfig):
        rng = np.random.default_rng(config.seed)
        self.config, self.top = config, top
        self.a = rng.normal(size=(dimension + 1, config.tables * config.hashes))
        self.b = rng.random(config.tables * config.hashes) * config.width
        self.mixer = rng.integers(1, 1 << 62, size=config.hashes, dtype=np.int64) | 1

    def places(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Projections in units of the width: vector x table x hash."""
        scaled = vectors / (np.linalg.norm(vectors, axis=1, keepdims=True) if query else self.top)
        rest = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))
        full = np.concatenate([scaled, rest[:, None]], axis=1)
        return ((full @ self.a + self.b) / self.config.width).reshape(len(vectors), self.config.tables, self.config.hashes)

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """One number for each row of rounded hashes."""
        with np.errstate(over="ignore"):
            return (cells.astype(np.int64) * self.mixer).sum(axis=-1)

    def probes(self, place: np.ndarray, limit: int) -> np.ndarray:
        """Keys of the first ``limit`` buckets in the order of estimated success, for one query and table."""
        base = np.floor(place).astype(np.int64)
        part = place - base
        moves = sorted((float(c) ** 2, j, d) for j, p in enumerate(part) for c, d in ((p, -1), (1 - p, 1)))
        own = int(self.keys(base[None])[0])
        step = [int(self.mixer[j]) * d for _, j, d in moves]
        found, heap = [own], [(moves[0][0], (0,))]
        while heap and len(found) < limit:
            cost, chosen = heapq.heappop(heap)
            last = chosen[-1]
            if len({moves[m][1] for m in chosen}) == len(chosen):  # one hash does not move both ways
                found.append(own + sum(step[m] for m in chosen))
            if last + 1 < len(moves):
                heapq.heappush(heap, (cost + moves[last + 1][0], (*chosen, last + 1)))
                heapq.heappush(heap, (cost - moves[last][0] + moves[last + 1][0], (*chosen[:-1], last + 1)))
        return np.array([(k + (1 << 63)) % (1 << 64) - (1 << 63) for k in found], dtype=np.int64)


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector): rows that take part, components as doubles, one row for each id."""
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = table.select(F.col(id_col).alias("id"), F.transform(v, lambda x: x.cast("double")).alias("vector"), fine.alias("fine"))
    rows = rows.filter("id IS NOT NULL AND vector IS NOT NULL AND fine").drop("fine")
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("vector") == (sizes["n"] if sizes else 0))
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def hashes_for(n: int) -> int:
    """Hashes of a table over n vectors, so that a usual bucket holds some dozens to hundreds of them."""
    return max(4, round(0.7 * float(np.log2(max(n, 1) / 64 + 1))))


def cells_for(n: int, dimension: int, config: ProbeConfig) -> int:
    """Cells of an index over n vectors, so that what a task holds of it does not grow with n."""
    return max(config.cells, -(-config.tables * n * dimension // config.cell))


def fit_probes(hasher: Hasher, sample: np.ndarray, config: ProbeConfig) -> int | None:
    """The least number of probes that finds enough of the sample's own nearest neighbours; None if ``most`` are too few."""
    n, wanted = len(sample), min(config.wanted, len(sample) - 1)
    if wanted < 1:
        return 1
    queries = np.arange(min(config.trials, n))
    scores = sample[queries] @ sample.T
    scores[queries, queries] = -np.inf
    true = np.argpartition(-scores, wanted - 1, axis=1)[:, :wanted]
    keys = hasher.keys(np.floor(hasher.places(sample, query=False)).astype(np.int64))  # vector x table
    where = hasher.places(sample[queries], query=True)
    visit = np.full(true.shape, config.most)
    for q in range(len(queries)):
        for t in range(config.tables):
            turn = {k: i for i, k in enumerate(hasher.probes(where[q, t], config.most).tolist())}
            visit[q] = np.minimum(visit[q], [turn.get(k, config.most) for k in keys[true[q], t].tolist()])
    last = int(np.quantile(visit, config.recall, method="higher"))
    return 1 + last if last < config.most else None


def fitted(sample: np.ndarray, top: float, config: ProbeConfig) -> tuple[Hasher, int]:
    """Projections with as many hashes as the probes can serve, and the number of probes."""
    for hashes in range(config.hashes, 0, -1):
        tried = replace(config, hashes=hashes)
        hasher = Hasher(sample.shape[1], top, tried)
        limit = fit_probes(hasher, sample, tried)
        if limit is not None:
            return hasher, limit
    return hasher, config.most  # one hash: the buckets are intervals, and so many of them are all


def hashed_rows(rows: DataFrame, hasher: Hasher, query: bool, limit: int) -> DataFrame:
    """(id, table, key): the bucket of each vector in each table, or for queries all buckets to visit."""
    shared = rows.sparkSession.sparkContext.broadcast(hasher)  # a fixed number of projections

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1)
            places = h.places(vectors, query)
            ids = batch.column("id").to_numpy()
            for t in range(h.config.tables):
                if query:
                    lists = [h.probes(p, limit) for p in places[:, t]]
                    key, who = np.concatenate(lists), np.repeat(ids, [len(x) for x in lists])
                else:
                    key, who = h.keys(np.floor(places[:, t]).astype(np.int64)), ids
                yield pa.RecordBatch.from_arrays(
                    [pa.array(who, batch.schema.field("id").type), pa.array(np.full(len(who), t, np.int32)), pa.array(key)], ["id", "table", "key"]
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, table int, key long")


def cell_of(part: str, config: ProbeConfig) -> Column:
    """The cell to which a part of a bucket belongs."""
    return F.pmod(F.xxhash64(part), F.lit(config.cells)).cast("int")


def ranked(asked: DataFrame, index: DataFrame, queries: DataFrame, rows: DataFrame, config: ProbeConfig) -> DataFrame:
    """(q, id, score): for each task and query the best candidates of the visited parts of buckets.

    ``asked`` is (cell, q, parts), where no parts means the whole cell, ``index`` (id, part); cells are dealt to tasks.
    """
    kept = index.select(cell_of("part", config).alias("cell"), "id", "part").join(rows, "id")
    kept = kept.select("cell", F.lit(0).alias("kind"), "id", F.array("part").alias("parts"), "vector")
    asked = asked.join(queries.select(F.col("id").alias("q"), "vector"), "q")
    asked = asked.select("cell", F.lit(1).alias("kind"), F.col("q").alias("id"), "parts", "vector")
    both = kept.unionByName(asked).repartition("cell").sortWithinPartitions("cell", "kind", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        now, ids, vectors, order, starts = None, [], [], None, {}
        id_type = pa.int64()

        def emptied() -> pa.RecordBatch:
            q = np.repeat(list(best), [len(x) for x, _ in best.values()])
            out = [np.concatenate([x[i] for x in best.values()]) for i in (0, 1)]
            best.clear()
            return pa.RecordBatch.from_arrays([pa.array(q, id_type), pa.array(out[0], id_type), pa.array(out[1])], ["q", "id", "score"])

        for batch in batches:
            id_type = batch.schema.field("id").type
            cells, kinds, who = (batch.column(c).to_numpy() for c in ("cell", "kind", "id"))
            parts = batch.column("parts").to_pylist()
            flat = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, -1)
            for i in range(batch.num_rows):
                if cells[i] != now:
                    now, ids, vectors, order, held_parts = cells[i], [], [], None, []
                if kinds[i] == 0:
                    ids.append(who[i])
                    vectors.append(flat[i])
                    held_parts.append(parts[i][0])
                    continue
                if not ids:
                    continue
                if order is None:  # the cell's vectors are complete: sort them by part
                    order = np.argsort(held_parts, kind="stable")
                    sorted_parts = np.array(held_parts)[order]
                    cell_ids, cell_vectors = np.array(ids)[order], np.array(vectors)[order]
                    edge = np.flatnonzero(np.diff(sorted_parts)) + 1
                    starts = {sorted_parts[a]: (a, b) for a, b in zip([0, *edge], [*edge, len(order)], strict=True)}
                if parts[i] is None:
                    at = np.arange(len(order))
                else:
                    spans = [starts[p] for p in parts[i] if p in starts]
                    at = np.concatenate([np.arange(a, b) for a, b in spans]) if spans else np.zeros(0, np.int64)
                at = at[cell_ids[at] != who[i]]
                if not len(at):
                    continue
                rough = cell_vectors[at] @ flat[i]
                if len(at) > config.wanted:
                    floor = np.partition(rough, len(at) - config.wanted)[len(at) - config.wanted]
                    at = at[rough >= floor - 1e-9 * (1 + abs(floor))]
                score = (cell_vectors[at] * flat[i]).sum(axis=1)  # summed alike for equal vectors, so they tie
                own_ids, own_scores = best.get(who[i], (np.zeros(0, np.int64), np.zeros(0)))
                own_ids, first = np.unique(np.concatenate([own_ids, cell_ids[at]]), return_index=True)
                own_scores = np.concatenate([own_scores, score])[first]
                top = np.lexsort((own_ids, -own_scores))[: config.wanted]
                best[who[i]] = own_ids[top], own_scores[top]
            if len(best) * config.wanted > config.held:
                yield emptied()
        if best:
            yield emptied()

    kind = rows.schema["id"].dataType.simpleString()
    return both.mapInArrow(run, f"q {kind}, id {kind}, score double")


def nearest(table: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", config: ProbeConfig | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found rows of every row that ``is_query`` (over ``id``) selects."""
    config = config or ProbeConfig()
    rows = write_shared(usable(table, id_col, vector_col), "vectors")
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    facts = rows.agg(F.max(norm).alias("top"), F.max(F.size("vector")).alias("d"), F.count("*").alias("n")).first()
    few = rows.orderBy(F.xxhash64("id"), "id").limit(config.sample).collect()
    sample = np.array([r["vector"] for r in few]).reshape(len(few), facts["d"] or 1)
    config = replace(config, hashes=config.hashes or hashes_for(facts["n"]), cells=cells_for(facts["n"], facts["d"] or 1, config))
    hasher, limit = fitted(sample, float(np.sqrt(facts["top"] or 1.0)), config)
    config = hasher.config

    index = write_shared(hashed_rows(rows, hasher, query=False, limit=0), "index")
    counts = index.groupBy("table", "key").agg(F.count("*").alias("n"))
    salts = F.ceil(F.col("n") / config.salt).cast("int")

    def part(salt: Column) -> Column:
        return F.xxhash64("table", "key", salt).alias("part")

    parts = index.join(counts, ["table", "key"]).select("id", "table", part(F.pmod(F.xxhash64("id"), salts).cast("int")))
    parts = write_shared(parts, "parts")
    queries = rows.filter(is_query)
    own = F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt")
    visits = hashed_rows(queries, hasher, query=True, limit=limit).join(counts, ["table", "key"])
    visits = visits.select(F.col("id").alias("q"), "table", "key", own).select("q", part(F.col("salt")))
    # at most as many parts as probes
    asked = visits.groupBy(cell_of("part", config).alias("cell"), "q").agg(F.collect_set("part").alias("parts"))
    found = write_shared(ranked(asked, parts, queries, rows, config), "found")

    enough = found.select("q", "id").distinct().groupBy("q").count().filter(F.col("count") >= min(config.wanted, max(0, facts["n"] - 1)))
    poor = queries.join(enough.select(F.col("q").alias("id")), "id", "left_anti").select("id", "vector")
    whole = parts.filter(F.col("table") == 0)
    cells = F.explode(F.sequence(F.lit(0), F.lit(config.cells - 1))).alias("cell")
    every = poor.select(cells, F.col("id").alias("q"), F.lit(None).cast("array<bigint>").alias("parts"))
    exact = ranked(every, whole, poor, rows, config)
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    best = found.union(exact).groupBy("q", "id").agg(F.max("score").alias("score"))
    best = best.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= config.wanted)
    return best.select(F.col("q").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")
