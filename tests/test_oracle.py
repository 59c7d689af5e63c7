"""Every registered query against its SQL, and the shape of its plan."""

import pytest
from compare import check, duck

import __spark_entry__ as entry
from vellum.plans.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_oracle(spark, con, sf_dir, name):
    ok, message = check(spark, con, name, QUERIES[name], ORACLES.get(name), sf_dir)
    assert ok, message


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


# streams, and queries that store a step, run while they are built
PLANNED = [n for n in sorted(QUERIES) if not n.startswith("str_") and n not in ("que_turn", "que_rounds")]


@pytest.fixture(scope="module", params=["as usual", "no broadcast"])
def joins(request, spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    if request.param == "no broadcast":
        for name in names:
            spark.conf.set(name, "-1")
    yield request.param
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", PLANNED)
def test_plan(spark, sf_dir, joins, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan
    assert ("ArrowEvalPython" in plan) == (name == "prj_language_tag")
    # a window is there only to keep the first row of a key, which each task does before the shuffle
    windows = plan.count("Window [row_number")
    assert plan.count("WindowGroupLimit") >= windows
    # others number the ranges of a queue, or walk through the places of one document
    others = {"que_batches": "Window [sum(_n", "txt_rank_covers": "Window [max(p0"}.get(name)
    assert plan.count("Window [") - windows == (plan.count(others) if others else 0)
