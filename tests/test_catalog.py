"""Every catalogue query against its SQL on the small tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import differences
from loadstone.catalog import all_queries, all_sql

QUERIES, SQL = all_queries(), all_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(name, spark, sf_dir, connection):
    assert differences(QUERIES[name](spark, sf_dir), connection, SQL[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
