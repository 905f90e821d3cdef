"""Running SQL and writing tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import settings

WRITE_MODES = ("WRITE_APPEND", "WRITE_TRUNCATE", "WRITE_EMPTY")


def run_query(spark: SparkSession, sql: str, params: Mapping[str, object] | None = None) -> DataFrame:
    """The result of a query; each ``:name`` marker is bound to its parameter as text."""
    if not params:
        return spark.sql(sql)
    texts = {name: None if value is None else str(value) for name, value in params.items()}
    return spark.sql(sql, args=texts)


def load_table(df: DataFrame, table: str, mode: str = "WRITE_APPEND") -> None:
    """Write ``df`` to a table: append to it, replace its rows, or fill it only if it has none.

    A table that exists keeps its format, codec, partitions, buckets, properties and place; one that does not is
    created as Parquet. Columns go by name.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode {mode!r}")
    if mode == "WRITE_TRUNCATE":
        replace_table(df, table)
        return
    spark = df.sparkSession
    exists = spark.catalog.tableExists(table)
    if mode == "WRITE_EMPTY" and exists and not spark.table(table).isEmpty():
        raise ValueError(f"{table} already has rows")
    if exists:
        df.select(spark.table(table).columns).write.insertInto(table)
    else:
        df.write.saveAsTable(table)


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Replace the rows of a table by ``df``, which may read the table itself.

    ``partition_by`` and ``fmt`` are for a table that does not exist yet.
    """
    commit_table(df.sparkSession, stage_table(df, table, partition_by, fmt), table)


def stage_table(df: DataFrame, table: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> str:
    """Write ``df`` beside ``table`` and return the name of what was written."""
    staged = f"{table}__staged"
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {staged}")
    df.write.format(fmt).partitionBy(*partition_by).saveAsTable(staged)
    return staged


def commit_table(spark: SparkSession, staged: str, table: str, together: Callable[[DataFrame], DataFrame] = lambda df: df) -> None:
    """Make ``table`` hold the rows of ``staged``, which goes once they are there.

    A table that exists is overwritten in place, so that it never goes missing and stays what it is; if that fails, the
    staged rows are still there to be committed again. Where the staged columns are others than the table's, its
    definition cannot stay and the staged table takes the name. ``together`` may arrange rows before they are written.
    """
    if not spark.catalog.tableExists(table):
        _rename(spark, staged, table)
        return
    rows, columns = spark.table(staged), spark.table(table).columns
    if sorted(rows.columns) != sorted(columns):
        spark.sql(f"DROP TABLE {table}")
        _rename(spark, staged, table)
        return
    with settings(spark, spark__sql__sources__partitionOverwriteMode="static"):
        together(rows.select(columns)).write.insertInto(table, overwrite=True)
    spark.sql(f"DROP TABLE {staged}")


def _rename(spark: SparkSession, staged: str, table: str) -> None:
    spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    if any(column.isPartition for column in spark.catalog.listColumns(table)):
        # Some catalogs go on looking for the partitions under the old name.
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")


def query_to_table(spark: SparkSession, sql: str, table: str) -> None:
    """Write the result of a query to a table, always replacing it."""
    replace_table(spark.sql(sql), table)


def month_columns(df: DataFrame) -> list[str]:
    """The columns that hold months: dates named ``month`` or ``..._month``."""
    return [
        field.name
        for field in df.schema
        if isinstance(field.dataType, T.DateType) and (field.name == "month" or field.name.endswith("_month"))
    ]


def months_as_text(df: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """``df`` with its months (found by ``month_columns`` unless named) as ``yyyy-MM`` text."""
    texts = {name: F.date_format(name, "yyyy-MM") for name in (month_columns(df) if months is None else months)}
    return df.withColumns(texts) if texts else df


def stage_results(df: DataFrame, table: str, months: Sequence[str] | None = None) -> str | None:
    """Compute a result once, into a table beside ``table``, its months as ``yyyy-MM`` text; None if it is empty."""
    spark = df.sparkSession
    staged = stage_table(months_as_text(df, months), table)
    if spark.table(staged).isEmpty():
        spark.sql(f"DROP TABLE {staged}")
        return None
    return staged


def load_results(
    df: DataFrame, table: str, mode: str = "WRITE_TRUNCATE", months: Sequence[str] | None = None
) -> bool:
    """Write a result with its months (found by ``month_columns`` unless named) as text.

    An empty result leaves the old table alone; the return value says whether there was any row.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"unknown write mode {mode!r}")
    spark = df.sparkSession
    staged = stage_results(df, table, months)
    if staged is None:
        return False
    if mode == "WRITE_TRUNCATE":
        commit_table(spark, staged, table)
    else:
        load_table(spark.table(staged), table, mode)
        spark.sql(f"DROP TABLE {staged}")
    return True


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.where("col_name = 'Location'").select("data_type").first()[0]
