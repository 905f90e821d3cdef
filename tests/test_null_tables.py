"""All queries on tables with many NULLs, in keys as well as values."""

import duckdb
import pytest
from check_oracle import TABLES, check, oracle_connection

from tidemark.catalog.oracle import ORACLE_SQL

SOURCE = "/root/testdata/sf0.001"
# Row identity of each table, and the columns that lose one in so many of their values.
MISSING = {
    "orders": ("o_orderkey", {"o_custkey": 5, "o_totalprice": 7, "o_orderdate": 11, "o_orderpriority": 13}),
    "events": ("event_id", {"user_id": 5, "ts": 7, "value": 11}),
    "lineitem": (
        "l_orderkey * 10 + l_linenumber",
        {"l_quantity": 5, "l_returnflag": 7, "l_linestatus": 11, "l_shipdate": 13},
    ),
    "customer": ("c_custkey", {"c_mktsegment": 9, "c_acctbal": 8}),
}


@pytest.fixture(scope="module")
def with_nulls(tmp_path_factory):
    folder = tmp_path_factory.mktemp("nulls")
    connection = duckdb.connect()
    for table in TABLES:
        rows = f"SELECT * FROM '{SOURCE}/{table}.parquet'"
        if table in MISSING:
            identity, columns = MISSING[table]
            changed = ", ".join(
                f"CASE WHEN hash({identity}, '{column}') % {one_in} > 0 THEN {column} END AS {column}"
                for column, one_in in columns.items()
            )
            rows = f"SELECT * REPLACE ({changed}) FROM ({rows})"
        connection.execute(f"COPY ({rows}) TO '{folder}/{table}.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql_with_nulls(spark, with_nulls, name):
    connection = oracle_connection(with_nulls)
    connection.execute("SET default_null_order = 'NULLS_FIRST_ON_ASC_LAST_ON_DESC'")
    assert check(spark, connection, name, with_nulls) is None
