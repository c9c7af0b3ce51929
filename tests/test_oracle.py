"""Every registered query beside its checking SQL, on the smallest data set."""

import os

import pytest

from __spark_entry__ import entry
from oracle.queries import oracle_sql
from stintlake.plans.registry import QUERIES
from tests.compare import connect, differences

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "position" in df.columns


# These put one-row counts beside each other.
ONE_ROW_PRODUCTS = {"bronze_to_silver", "silver_to_gold", "silver_gold_lineage"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "MapInPandas" not in plan
    if name not in ONE_ROW_PRODUCTS:
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    _, bad = differences(df, con, SQL[name])
    assert not bad, bad
