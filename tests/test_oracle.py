"""Every catalog query against its DuckDB SQL (row count, columns, values).
Runs at $TEST_SF_DIR (sf0.001 by default; the driver's gate is sf0.01, see
tests/oracle_check.py)."""

import pytest

import __spark_entry__ as E
from basketry.plans.catalog import QUERIES
from oracle_check import compare, duck

from conftest import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) and set(NAMES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL)
    assert res["status"] == "ok", res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["category", "total_revenue", "total_purchases"]
    assert df.count() > 0
