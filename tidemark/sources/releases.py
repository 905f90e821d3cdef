"""Results that change together: versions beside each other, and one pointer that says which of them readers see.

The rows of a result lie in ``<name>__versions``, a table partitioned by version whose partitions are written once and never
changed. ``releases__`` of the same database lists, per release and result, the version that holds from then on. The result
itself is a view: it reads the version that the last release names. A release is one file of a few rows in ``releases__``, so
it is there or it is not, for all results at once. Whatever fails before leaves unnamed partitions behind that no reader sees.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.session import settings

VERSION = "version__"


def publish(spark: SparkSession, database: str, results: Mapping[str, DataFrame]) -> dict[str, bool]:
    """Computes all results, then shows them to readers in one step; False marks a result without rows, which stays as it was.

    A column that a result gains or loses is all NULL for readers while the old release holds; a column that changes its type raises
    before anything is shown. A plain table of a result's name becomes its first version.
    """
    release = _last_release(spark, database) + 1
    staged = {name: stage(df, database, name, release) for name, df in results.items()}
    columns = {name: df.columns for name, df in results.items()}
    shown = {name: version for name, version in staged.items() if version is not None}
    for name in shown:
        _show(spark, database, name, _columns(spark, database, name))
    switch(spark, database, shown, release)
    for name in shown:  # columns that only older versions have go
        _show(spark, database, name, columns[name])
    return {name: version is not None for name, version in staged.items()}


def stage(df: DataFrame, database: str, name: str, release: int) -> str | None:
    """Writes a result as a new version that no reader sees yet, and returns the version; None if there are no rows."""
    spark, table = df.sparkSession, f"{database}.{name}__versions"
    if _is_table(spark, f"{database}.{name}"):
        _adopt(spark, database, name)
    _prepare(df, table)
    version = f"{release:012d}-{uuid.uuid4().hex}"
    columns = [F.col(f"`{field.name}`") if field.name in df.columns else F.lit(None).cast(field.dataType).alias(field.name) for field in spark.table(table).schema if field.name != VERSION]
    with settings(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        df.select(*columns, F.lit(version).alias(VERSION)).write.insertInto(table)
    return version if not spark.table(table).where(F.col(VERSION) == version).isEmpty() else None


def switch(spark: SparkSession, database: str, versions: Mapping[str, str], release: int) -> None:
    """The one step that readers notice: a file that names the new version of each result."""
    if versions:
        rows = [(release, name, version) for name, version in versions.items()]
        _pointer(spark, database)
        spark.createDataFrame(rows, "release bigint, name string, version string").coalesce(1).write.insertInto(f"{database}.releases__")


def prune(spark: SparkSession, database: str, keep: int = 2) -> int:
    """Drops the versions that no result has shown since the last ``keep`` releases, and returns how many.

    Readers that began under a release that old must have ended. What a failed run left behind goes too, once it is as old.
    """
    if keep < 1:
        raise ValueError("the release that readers see must stay")
    _pointer(spark, database)
    named = [tuple(row) for row in spark.table(f"{database}.releases__").collect()]  # a few rows per release
    oldest = max((release for release, _, _ in named), default=0) - keep + 1
    needed = {version for release, _, version in named if release > oldest}
    for result in {name for _, name, _ in named}:  # what the oldest kept release shows
        upto = [(release, version) for release, name, version in named if name == result and release <= oldest]
        needed |= {max(upto)[1]} if upto else set()
    dropped = 0
    for table in spark.catalog.listTables(database):
        if table.name.endswith("__versions"):
            for row in spark.sql(f"SHOW PARTITIONS {database}.{table.name}").collect():
                version = row["partition"].removeprefix(f"{VERSION}=")
                if version not in needed and int(version.split("-")[0]) < oldest:
                    spark.sql(f"ALTER TABLE {database}.{table.name} DROP PARTITION ({VERSION} = '{version}')")
                    dropped += 1
    return dropped


def _last_release(spark: SparkSession, database: str) -> int:
    _pointer(spark, database)
    return spark.table(f"{database}.releases__").agg(F.max("release")).first()[0] or 0


def _pointer(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.releases__ (release BIGINT, name STRING, version STRING) USING parquet")
    spark.catalog.refreshTable(f"{database}.releases__")


def _is_table(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW"


def _columns(spark: SparkSession, database: str, name: str) -> list[str]:
    return [column for column in spark.table(f"{database}.{name}__versions").columns if column != VERSION]


def _prepare(df: DataFrame, table: str) -> None:
    """Makes the table of versions, or adds to it the columns that it lacks."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        fields = T.StructType([*df.schema.fields, T.StructField(VERSION, T.StringType())])
        spark.createDataFrame([], fields).write.partitionBy(VERSION).saveAsTable(table)
        return
    known = {field.name: field.dataType for field in spark.table(table).schema}
    changed = [field.name for field in df.schema if field.name in known and known[field.name] != field.dataType]
    if changed:
        raise ValueError(f"{table} has other types in {', '.join(changed)}")
    new = [f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema if field.name not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")


def _show(spark: SparkSession, database: str, name: str, columns: Sequence[str]) -> None:
    view = f"{database}.{name}"
    if spark.catalog.tableExists(view) and spark.table(view).columns == list(columns):
        return
    listed = ", ".join(f"`{column}`" for column in columns)
    spark.sql(
        f"""CREATE OR REPLACE VIEW {view} AS SELECT {listed} FROM {database}.{name}__versions
        WHERE {VERSION} = (SELECT max_by(version, release) FROM {database}.releases__ WHERE name = '{name}')"""
    )


def _adopt(spark: SparkSession, database: str, name: str) -> None:
    """Makes the rows of a plain table the first version. Only while the table gives way to the view is its name not there."""
    rows = spark.table(f"{database}.{name}")
    _prepare(rows, f"{database}.{name}__versions")
    version = f"{0:012d}-{uuid.uuid4().hex}"
    rows.select(*[F.col(f"`{column}`") for column in _columns(spark, database, name)], F.lit(version).alias(VERSION)).write.insertInto(f"{database}.{name}__versions")
    switch(spark, database, {name: version}, 0)
    columns = rows.columns
    spark.sql(f"DROP TABLE {database}.{name}")
    _show(spark, database, name, columns)
