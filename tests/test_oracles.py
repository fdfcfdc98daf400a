"""Every registered query runs; those with SQL must equal DuckDB's answer."""

import pytest
from check import compare, duck

import __spark_entry__ as entry
from cartlens.catalog.registry import FUNCTIONS, Data

# the training-data queries, if they are there, have their own tests
QUERIES = {n: q for n, q in entry.queries().items() if n in FUNCTIONS}
ORACLES = {n: sql for n, sql in entry.oracle_sql().items() if n in FUNCTIONS}


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.fixture(scope="module")
def data(spark, folder):
    """Shared, so that the reduced tables are written once for all queries."""
    return Data(spark, folder)


def test_sql_belongs_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(data, con, name):
    assert compare(FUNCTIONS[name](data), con.execute(ORACLES[name]).df()) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(data, name):
    df = FUNCTIONS[name](data)
    assert df.columns and df.count() > 0


def test_queries_build_their_own_tables(spark, folder, con):
    name = "k11_sales_per_month"
    assert compare(QUERIES[name](spark, folder), con.execute(ORACLES[name]).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
