"""Key statistics of tables: which keys have very many rows, kept beside the table and used only while they are fresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.skew import HOT_ROWS, hot_keys
from tidemark.sources.warehouse import replace_table, table_location

KEPT = "column string, key string, rows bigint, least_rows bigint, files string"


def table_files(spark: SparkSession, table: str) -> str:
    """What files a table has, as a short text: their number and a sum of hashes of paths, sizes and times. None is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(table_location(spark, table))
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    counted = files.agg(F.count(F.lit(1)).alias("n"), F.sum(one).alias("sum")).first()
    return f"{counted['n']} {counted['sum']}"


def keep_key_statistics(spark: SparkSession, table: str, column: str, least_rows: int = HOT_ROWS) -> None:
    """Counts the rows of every key (NULL is one) and keeps those with more than ``least_rows``, at most rows / least_rows keys.

    The counts go to ``<table>__keys``, together with what files the table had, in place of older ones of this column.
    """
    files = table_files(spark, table)
    counted = spark.table(table).groupBy(F.col(column).cast("string").alias("key")).agg(F.count(F.lit(1)).alias("rows"))
    of_column = {"column": F.lit(column), "least_rows": F.lit(least_rows).cast("bigint"), "files": F.lit(files)}
    names = [part.split(" ")[0] for part in KEPT.split(", ")]
    found = counted.where(F.col("rows") > least_rows).withColumns(of_column).select(names)
    # A row without a key's count says that there are statistics, even if no key has so many rows.
    header = spark.createDataFrame([(column, None, None, least_rows, files)], KEPT)
    kept = found.unionByName(header)
    if spark.catalog.tableExists(f"{table}__keys"):
        kept = kept.unionByName(spark.table(f"{table}__keys").where(F.col("column") != column))
    replace_table(kept, f"{table}__keys")


def known_hot_keys(spark: SparkSession, table: str, column: str, hot_rows: int = HOT_ROWS) -> tuple[DataFrame | None, int] | None:
    """The keys with more than ``hot_rows`` rows and how many rows they have, as ``skew.hot_keys``; None if statistics do not tell.

    They do not tell if there are none, if they only hold larger keys, or if the table's files are others now.
    """
    if not spark.catalog.tableExists(f"{table}__keys"):
        return None
    kept = spark.table(f"{table}__keys").where(F.col("column") == column)
    header = kept.where("rows IS NULL").first()
    if header is None or header["least_rows"] > hot_rows or header["files"] != table_files(spark, table):
        return None
    kind = spark.table(table).schema[column].dataType
    hot = kept.where(F.col("rows") > hot_rows)
    rows = hot.agg(F.sum("rows")).first()[0]
    return (None, 0) if rows is None else (hot.select(F.col("key").cast(kind).alias(column)), rows)


def hot_keys_of(spark: SparkSession, table: str, column: str, hot_rows: int = HOT_ROWS) -> tuple[DataFrame | None, int]:
    """Hot keys from fresh statistics, which reads no rows, or else by a search in the table."""
    known = known_hot_keys(spark, table, column, hot_rows)
    return hot_keys(spark.table(table), [column], hot_rows) if known is None else known
