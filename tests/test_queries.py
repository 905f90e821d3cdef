"""Every registered query against its SQL on the smallest tables."""

import pytest
from check_oracle import check, oracle_connection

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.catalog.oracle import ORACLE_SQL
from tidemark.catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, connection, name):
    assert check(spark, connection, name, SF_DIR) is None


def test_every_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(ORACLE_SQL) <= set(oracle_sql()) and set(QUERIES) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["cohort_month", "period", "active_customers", "retention_pct"]
