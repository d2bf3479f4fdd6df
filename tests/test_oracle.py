"""Every registered query against its SQL at the smallest scale."""

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry
from claimloom.catalog.oracle import oracle_sql
from claimloom.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, SF, name, QUERIES[name], SQL[name])
    assert ok, note


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and len(df.columns) == 11


def test_oracle_does_not_read_the_contracts_it_checks():
    import inspect

    from claimloom.catalog import oracle

    assert "from claimloom" not in inspect.getsource(oracle)
