"""Every query against its SQL at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import difference, oracle_connection

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = queries(), oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(FOLDER)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_sql(spark, connection, key):
    assert difference(spark, connection, FOLDER, QUERIES[key], ORACLE[key]) is None


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_other_queries_give_rows(spark, key):
    assert QUERIES[key](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
