"""Every registered query against its DuckDB oracle on sf0.001, the same
comparison the driver makes (columns by name, rows, value hash)."""

import pytest

import __spark_entry__ as entry
from conftest import SF001
from oracle_check import compare, duck

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], SQL[name], SF001)
    assert r["status"] == "ok", r


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
