"""Every SQL-checkable query against its DuckDB oracle on the smallest test tables."""

import pytest

import __spark_entry__ as entry
from scripts.check_oracle import compare_frames, duckdb_connection

SQL = entry.oracle_sql()
QUERIES = entry.queries()


def test_every_query_key_has_a_callable():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) >= 60


@pytest.fixture(scope="module")
def con(sf_small):
    return duckdb_connection(sf_small)


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_sql(spark, sf_small, con, key):
    got = QUERIES[key](spark, sf_small).toPandas()
    want = con.execute(SQL[key]).df()
    problem = compare_frames(got, want)
    assert problem is None, problem


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "orders_count" in df.columns
