"""Registered queries: agreement with SQL, and plans that hold at scale."""

import os

import pytest

import __spark_entry__ as entry
from checks import registry
from checks.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def oracle():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, oracle, name):
    df = entry.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert bad not in plan, f"{bad} in the plan of {name}"
    got = df.toPandas()
    assert name in entry.oracle_sql()
    assert differences(got, oracle.execute(entry.oracle_sql()[name]).df()) == []


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def plan_of(spark, name):
    return entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark):
    assert "GreaterThanOrEqual(l_shipdate" in plan_of(spark, "year_filter")


def test_top1_is_limited_before_the_shuffle(spark):
    plan = plan_of(spark, "top1_per_key")
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_newest_version_is_aggregated_before_the_shuffle(spark):
    plan = plan_of(spark, "claims_latest_version")
    assert "partial_max_by" in plan and "Window" not in plan
