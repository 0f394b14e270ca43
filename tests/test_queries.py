"""Every registered query against its DuckDB text on the smallest data."""

import pytest

import __spark_entry__ as driver
from checks.compare import compare, connect
from checks.oracle import ORACLE
from checks.queries import QUERIES
from tests.conftest import SMALL, plan_of


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("key", list(QUERIES))
def test_matches_duckdb(spark, con, key):
    df = QUERIES[key](spark, SMALL)
    plan = plan_of(df)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval"):
        assert operator not in plan
    assert compare(df, con, ORACLE[key]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_runs(spark):
    df = driver.entry(spark)
    assert len(df.columns) == 14
    assert df.count() > 0

