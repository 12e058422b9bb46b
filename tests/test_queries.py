"""Every registered query beside its SQL counterpart, on the smallest data."""

import re

import pytest
from compare import connect, differences

import __spark_entry__ as entry_module

QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()
ROWS_ONLY = {name for name in QUERIES if re.match(r"op\d+_|pipeline$", name)}  # tested on their own


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) - set(ORACLES) <= ROWS_ONLY
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, sf, name):
    n, problems = differences(spark, duck, name, QUERIES[name], ORACLES[name], sf)
    assert not problems
    assert n > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["publications", "incremental_anti_prefix", "run_report", "gather_pages", "latest_by_key"])
def test_no_cross_joins(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
