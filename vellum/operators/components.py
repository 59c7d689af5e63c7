"""Connected components of a graph that is a table of edges.

The graph is contracted by alternating large and small stars: every node hands its larger neighbours to its smallest one,
then hands all its smaller neighbours to the smallest of them, until the edges are stars around the smallest node of each component.
Each half round is two shuffles over the edges and is stored, so a lost executor repeats one of them. A node with very many
neighbours, which is what the middle of a star becomes, is aggregated to its minimum before the shuffle and joined back
as a key with one partner, which adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.operators.matching import id_rows
from vellum.session import cut_lineage


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the smallest among it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("_least"))
    linked = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return linked.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them; edges go from the larger to the smaller end."""
    least = edges.groupBy("a").agg(F.min("b").alias("_least"))
    linked = edges.join(least, "a").select(F.col("b").alias("a"), F.col("_least").alias("b"))
    return linked.unionByName(least.select("a", F.col("_least").alias("b"))).where("a <> b").distinct()


def _digest(edges: DataFrame) -> tuple:
    """A number of edges and an order-free sum of them, which stays when the edges do."""
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the root is the smallest node of its component.

    Both columns need one type that can be compared. Loops and NULLs are ignored, repeated edges do no harm, and an empty
    table gives no rows.
    """
    usable = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    current = cut_lineage(usable.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = _digest(current)
    while before[0]:
        current = cut_lineage(_small_star(cut_lineage(_large_star(current), "edges")), "edges")
        after = _digest(current)
        if after == before:
            break
        before = after
    roots = current.select("b").distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("b").alias("node"), F.col("b").alias("root"))
    )


def shared_value_components(rows: DataFrame, key: str, id_cols: Sequence[str]) -> DataFrame:
    """(node, root) of the rows that share a value of one of ``id_cols`` with another row, directly or over others.

    Every row is linked to the smallest key that holds its value, so a value on a third of the table is that many edges and
    no pairs. Rows that share nothing are absent.
    """
    held = id_rows(rows, id_cols, key)
    smallest = held.groupBy("id_type", "id_value").agg(F.min(key).alias("_hub"))
    edges = held.join(smallest, ["id_type", "id_value"]).select(F.col(key).alias("a"), F.col("_hub").alias("b"))
    return connected_components(edges)
