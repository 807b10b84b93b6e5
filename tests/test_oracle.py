"""Every registered query with an SQL oracle matches DuckDB on the smallest scale
factor (the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck

SQL = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_a_callable():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) >= 100


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, sf_dir, con, name):
    r = compare(spark, sf_dir, name, QUERIES[name], SQL[name], con)
    assert r["status"] == "ok", r


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 4
    assert set(df.columns) >= {"feature", "mean", "median", "std", "skewness", "kurtosis"}
