"""All queries on tables in which one customer, order and user has a third of the rows, and rows repeat."""

import duckdb
import pytest
from check_oracle import TABLES, check, oracle_connection

from tidemark.catalog.oracle import ORACLE_SQL

SOURCE = "/root/testdata/sf0.001"
HOT = {"orders": ("o_custkey", "o_orderkey"), "events": ("user_id", "event_id"), "lineitem": ("l_orderkey", "l_partkey + l_linenumber")}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for table in TABLES:
        rows = f"SELECT * FROM '{SOURCE}/{table}.parquet'"
        if table in HOT:
            key, spread = HOT[table]
            rows = f"SELECT * REPLACE (CASE WHEN hash({spread}) % 3 = 0 THEN 7 ELSE {key} END AS {key}) FROM ({rows})"
            rows = f"WITH moved AS ({rows}) FROM moved UNION ALL FROM moved WHERE hash({spread}, 1) % 10 = 0"
        connection.execute(f"COPY ({rows}) TO '{folder}/{table}.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql_on_skewed_tables(spark, skewed, name):
    assert check(spark, oracle_connection(skewed), name, skewed) is None
