"""Every registered query on the smallest tables against its SQL."""

import pytest

import __spark_entry__ as entry
from compare import connection, difference

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connection(SF)


def test_names():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    assert difference(spark, con, SF, QUERIES[name], SQL[name]) is None
