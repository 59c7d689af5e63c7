"""Join helpers for large many-to-one joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.session import cut_lineage

#: Keys that are sent to every task at most; more of them meet the rows in a shuffle.
SENT_KEYS = 1 << 21


def with_keys(rows: DataFrame, keys: DataFrame, key: str, n: int) -> DataFrame:
    """The rows whose key is among the ``n`` ``keys``, which should be stored.

    Few keys go to every task, so that the rows, texts and all, stay where they are. A size alone does not tell Spark this: what
    is known of keys taken from a batch of texts is the size of the texts.
    """
    wanted = keys.select(key)
    return rows.join(F.broadcast(wanted) if n <= SENT_KEYS else wanted, key, "left_semi")


def spread_nulls(key: Column, by: Sequence[str]) -> Column:
    """The key, with rows that have none spread over all tasks instead of meeting in one."""
    filler = F.concat(F.lit("\u0000"), F.xxhash64(*by).cast("string"))
    return F.coalesce(key.cast("string"), filler)


def left_lookup(left: DataFrame, right: DataFrame, key: str, right_key: str, spread_by: Sequence[str]) -> DataFrame:
    """Left join on a key that is unique in ``right`` and may be missing in ``left``.

    A hot key has one partner only, so adaptive execution can split it; rows without a key never share a task.
    """
    probe = left.withColumn("_probe", spread_nulls(F.col(key), spread_by))
    partner = right.withColumn("_partner", F.col(right_key).cast("string")).drop(right_key)
    same = (F.col("_probe") == F.col("_partner")) & F.col(key).isNotNull()
    return probe.join(partner, same, "left").drop("_probe", "_partner")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], last: bool = False) -> DataFrame:
    """One whole row per key: the first (or last) in ``order``, which must end in a unique column.

    A numbered window of which only the first row is kept: each task keeps its first row per key before the shuffle, so a
    key that holds a third of the table reaches the final task as one row per input task.
    """
    places = [F.col(o) if isinstance(o, str) else o for o in order]
    window = Window.partitionBy(*keys).orderBy(*[c.desc() if last else c.asc() for c in places])
    return df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")


def numbered(rows: DataFrame, order: Sequence[str], name: str = "place") -> DataFrame:
    """Rows with their place (from 0) in the order of the whole table; ``order`` must end in a unique column.

    Ranges of the order are numbered task by task and stored; the sizes of the ranges, one row each, give the offsets.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    stored = cut_lineage(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(earlier, F.lit(0)).alias("_before"))
    placed = stored.join(offsets, part == F.col("_part"))
    return placed.withColumn(name, F.col("_before") + inside).drop("_at", "_part", "_before")
