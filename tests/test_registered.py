"""Every registered query with a SQL counterpart gives the same rows as the SQL."""

import pytest
from compare import compare, duck

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
SQL = oracle_sql()
QUERIES = queries()


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, connection, name):
    assert compare(spark, connection, SF_DIR, QUERIES[name], SQL[name]) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_flagship(spark):
    assert entry(spark).count() > 0
