"""Run registered queries beside their oracle SQL and report differences."""

from __future__ import annotations

import decimal
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def check(spark, con, name, query, sql, sf_dir):
    """(ok, message) for one query."""
    started = time.time()
    df = query(spark, sf_dir)
    found = rows_of(df.columns, df.collect())
    took = time.time() - started
    n = sum(found.values())
    if sql is None:
        return n > 0, f"{name}: {n} rows, no oracle, {took:.1f}s"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    started = time.time()
    expected = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"{name}: columns {sorted(df.columns)} != {sorted(columns)}"
    if found != expected:
        extra, missing = list((found - expected).items())[:2], list((expected - found).items())[:2]
        return False, (
            f"{name}: {n} rows vs {sum(expected.values())}\n   only spark: {str(extra)[:700]}\n"
            f"   only oracle: {str(missing)[:700]}"
        )
    return n > 0, f"{name}: {n} rows equal, {took:.1f}s (oracle {time.time() - started:.1f}s)"


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from vellum.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    chosen = argv[1:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failures = duck(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if chosen and not any(name.startswith(c) for c in chosen):
            continue
        try:
            ok, message = check(spark, con, name, query, sqls.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, message = False, f"{name}: {type(error).__name__} {str(error)[:900]}"
        failures += not ok
        print("ok  " if ok else "FAIL", message, flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parent.parent))
    sys.exit(1 if main(sys.argv[1:]) else 0)
