"""Content digests: order-free, sensitive to every value, and the same in another engine."""

import duckdb
from pyspark.sql import functions as F

from vellum.operators.digests import content_digest, digest_sql

ROWS = [
    ("W1", "a", 1, 0.25, True, None), ("W1", "a", 1, 0.25, True, None), ("W1", None, 2, None, False, "x|y"), ("W2", "~", -3, 1.5, None, ""),
    ("W3", "é漢", 2**40, 0.1, True, "z"),
]
SCHEMA = "id string, a string, b bigint, c double, d boolean, e string"


def digests(rows):
    return {r["id"]: (r["n"], r["digest"]) for r in content_digest(rows, "id").collect()}


def test_order_and_repeats(spark):
    whole = digests(spark.createDataFrame(ROWS, SCHEMA))
    assert digests(spark.createDataFrame(ROWS[::-1], SCHEMA).repartition(3)) == whole
    assert whole["W1"][0] == 3 and digests(spark.createDataFrame(ROWS[1:], SCHEMA))["W1"] != whole["W1"]


def test_one_other_value_of_equal_count_shows(spark):
    whole = spark.createDataFrame(ROWS, SCHEMA)
    for column, value in (("a", "b"), ("b", 7), ("c", 0.75), ("d", None), ("e", "w")):
        other = whole.withColumn(column, F.when(F.col("id") == "W3", F.lit(value)).otherwise(F.col(column)))
        found, expected = digests(other), digests(whole)
        assert found["W3"][0] == expected["W3"][0] and found["W3"][1] != expected["W3"][1]
        assert found["W1"] == expected["W1"]


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id VARCHAR, a VARCHAR, b BIGINT, c DOUBLE, d BOOLEAN, e VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?, ?)", ROWS)
    kinds = {"id": "text", "a": "text", "b": "text", "c": "fraction", "d": "text", "e": "text"}
    found = con.execute(digest_sql("SELECT * FROM t", "id", kinds)).fetchall()
    assert {r[0]: r[1:] for r in found} == digests(spark.createDataFrame(ROWS, SCHEMA))
