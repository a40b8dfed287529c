"""Every registered query against its DuckDB SQL on the driver's tables
(the driver's own gate runs the same comparison at sf0.01)."""

import os

import pytest

import __spark_entry__ as E
from conftest import SF001
from oracle_compare import compare, duck

SF = os.environ.get("VOLTAIC_ORACLE_SF", SF001)
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, QUERIES, ORACLE, con)
    assert r["status"] in ("match", "rows-only"), r


def test_every_sql_query_has_a_spark_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "avg_demand_mw" in df.columns
