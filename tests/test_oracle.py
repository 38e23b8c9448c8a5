"""Every query with SQL gives the same rows as DuckDB."""

import pytest

from compare import connect, difference
from slotwise import catalog, oracle

FOLDER = "/root/testdata/sf0.01"
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    got = catalog.queries()[name](spark, FOLDER).toPandas()
    assert difference(got, con.execute(SQL[name]).df()) is None
    assert len(got) > 0


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(catalog.queries())


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 23
    assert contract.queries().keys() >= catalog.queries().keys()
