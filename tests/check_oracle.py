"""Compare queries with their SQL: ``python tests/check_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from tidemark.catalog.queries import drop_databases  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events".split()
OTHERS = "documents embeddings pages benchmark labels conversations".split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in [*TABLES, *[name for name in OTHERS if os.path.exists(f"{sf_dir}/{name}.parquet")]]:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def comparable(frame: pd.DataFrame) -> list[tuple]:
    """Rows as texts, columns by name, in an order of their own."""
    frame = frame[sorted(frame.columns)]

    def text(value) -> str:
        if value is None or value is pd.NaT or value != value:
            return "NULL"
        if hasattr(value, "isoformat"):
            return pd.Timestamp(value).isoformat()
        return repr(value.item() if hasattr(value, "item") else value)

    return sorted(tuple(map(text, row)) for row in frame.astype(object).itertuples(index=False))


def rows_as_pandas(df) -> pd.DataFrame:
    return df.toArrow().to_pandas(integer_object_nulls=True, date_as_object=True, timestamp_as_object=True)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} and {sorted(sql_frame.columns)}"
    ours, theirs = comparable(spark_frame), comparable(sql_frame)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows and {len(theirs)} rows"
    wrong = [pair for pair in zip(ours, theirs) if pair[0] != pair[1]]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def check(spark, connection, name: str, sf_dir: str) -> str | None:
    ours = rows_as_pandas(queries()[name](spark, sf_dir))
    drop_databases(spark)
    theirs = connection.sql(oracle_sql()[name]).to_arrow_table().to_pandas(
        integer_object_nulls=True, date_as_object=True, timestamp_as_object=True
    )
    if ours.empty:
        return "no rows"
    return differences(ours, theirs)


if __name__ == "__main__":
    from tidemark.session import get_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(queries())
    spark = get_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    bad = 0
    for name in names:
        started = time.time()
        try:
            if name in oracle_sql():
                problem = check(spark, connection, name, sf_dir)
            else:
                problem = None if queries()[name](spark, sf_dir).count() else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += problem is not None
        print(f"{name:40s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} ok")
    sys.exit(bad > 0)
