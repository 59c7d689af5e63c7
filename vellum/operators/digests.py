"""Digests of table contents that do not depend on the order of rows, and that other engines can compute as well."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates columns, what stands for a missing value, how many digits of a fraction count.
SEPARATOR, MISSING, FRACTION = "|", "~", 1_000_000


def _text(name: str, kind: str) -> Column:
    """One value as text: fractions in millionths, moments to the second, lists joined."""
    c = F.col(f"`{name}`")
    if kind in ("float", "double"):
        c = F.round(c.cast("double") * FRACTION).cast("bigint")
    elif kind.startswith("timestamp"):
        c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    elif kind.startswith("array"):
        c = F.array_join(c.cast("array<string>"), SEPARATOR, MISSING)
    return F.coalesce(c.cast("string"), F.lit(MISSING))


def row_hash(df: DataFrame) -> Column:
    """60 bits of the MD5 of a row, its columns in the order of their names."""
    parts = [_text(name, kind) for name, kind in sorted(df.dtypes)]
    return F.conv(F.substring(F.md5(F.concat_ws(SEPARATOR, *parts)), 1, 15), 16, 10).cast("decimal(20,0)")


def content_digest(table: DataFrame, key: str) -> DataFrame:
    """(key, n, digest): number of rows of each key and the sum of their hashes, as text. Equal rows count as often as they occur."""
    hashed = table.select(F.col(key), row_hash(table).alias("_hash"))
    return hashed.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum("_hash").cast("string").alias("digest"))


def digest_sql(rows: str, key: str, columns: dict[str, str]) -> str:
    """The same as SQL over a query; ``columns`` are its columns with ``text``, ``fraction`` or another kind."""
    parts = [
        f"coalesce(CAST({f'CAST(round({c} * {FRACTION}) AS BIGINT)' if kind == 'fraction' else c} AS VARCHAR), '{MISSING}')"
        for c, kind in sorted(columns.items())
    ]
    hashed = f"CAST(('0x' || substr(md5(concat_ws('{SEPARATOR}', {', '.join(parts)})), 1, 15)) AS BIGINT)"
    return f"SELECT {key}, count(*) AS n, CAST(sum(CAST({hashed} AS HUGEINT)) AS VARCHAR) AS digest FROM ({rows}) GROUP BY {key}"
