"""Every named query against its DuckDB twin (sf0.001), plus streaming vs
batch and the driver entry."""

import pytest

import __spark_entry__ as entry
from conftest import SF001
from loadlens.plans.registry import QUERIES as CORE
from oracle_compare import compare, duck

QUERIES = {k: v for k, v in entry.queries().items() if k in CORE}
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in CORE}


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "cpu_usage_mean" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], SF001)
    assert ok, msg
