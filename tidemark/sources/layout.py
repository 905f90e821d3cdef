"""Table layout: partitions, buckets, codecs, file sizes and statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.measures import money_sum
from tidemark.operators.skew import HOT_ROWS
from tidemark.session import settings
from tidemark.sources.statistics import hot_keys_of
from tidemark.sources.warehouse import commit_table, stage_table, table_location

EVENT_COLUMNS = ("customer_id", "event_type", "event_value", "session_id", "platform", "event_date", "region")
EVENT_PARTITIONS = ("event_date", "region")
# Buckets of a customer table, partitions of one load, bytes of a merged file, codecs.
BUCKETS = 256
BUCKET_BYTES = 2_000_000_000
TARGET_BYTES = 256_000_000
CODECS = {"hot": "snappy", "cold": "zlib"}


def create_event_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    """The event table: ORC with Snappy, partitioned by date (as text) and region."""
    place = f"LOCATION '{location}'" if location else ""
    spark.sql(
        f"""
        CREATE TABLE IF NOT EXISTS {table} (
            customer_id BIGINT, event_type STRING, event_value DOUBLE, session_id STRING, platform STRING,
            event_date STRING, region STRING
        ) USING ORC
        PARTITIONED BY (event_date, region)
        OPTIONS ('compression' 'snappy')
        {place}
        """
    )


def load_event_partitions(raw: DataFrame, table: str, since: str, max_partitions: int | None = None) -> None:
    """Overwrite the partitions that ``raw`` has rows for, and leave all others as they are.

    Rows are brought together by partition before the write so that files are few; a partition with
    too many rows for one task is spread over several. ``max_partitions`` refuses a load that would reach more;
    only then are partitions counted before, with a scan of the two columns.
    """
    spark = raw.sparkSession
    rows = (
        raw.where(F.col("created_at") >= F.lit(since).cast(raw.schema["created_at"].dataType))
        .withColumn("event_date", F.date_format("created_at", "yyyy-MM-dd"))
        .select(*EVENT_COLUMNS)
    )
    if max_partitions is not None:
        found = rows.select(*EVENT_PARTITIONS).distinct().limit(max_partitions + 1).count()
        if found > max_partitions:
            raise ValueError(f"the load has more than {max_partitions} partitions")
    with settings(spark, spark__sql__sources__partitionOverwriteMode="dynamic"):
        rows.hint("rebalance", *EVENT_PARTITIONS).write.insertInto(table, overwrite=True)


def file_codecs(spark: SparkSession, table: str) -> DataFrame:
    """The codec in the name of each file of a table, with the number of files that have it."""
    path = F.input_file_name()
    files = spark.table(table).select(path.alias("path")).distinct()
    codec = F.regexp_extract("path", r"\.([a-z0-9]+)\.[a-z]+$", 1)
    return files.groupBy(codec.alias("codec")).agg(F.count(F.lit(1)).alias("files"))


def write_bucketed(
    df: DataFrame, table: str, key: str, buckets: int = BUCKETS, path: str | None = None, codec: str = "snappy"
) -> None:
    """Write a table hashed into buckets on its join key, sorted within each bucket.

    Rows come together by bucket first, so there are not as many files as tasks times buckets; a
    bucket that is too large for one task is written by several.
    """
    placed = df.hint("rebalance", buckets, key)
    writer = placed.write.mode("overwrite").format("orc").option("compression", codec).bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)


def largest_bucket(spark: SparkSession, table: str) -> int:
    """Bytes of the largest bucket of a table; its files are listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(table_location(spark, table))
    bucket = F.regexp_extract("path", r"_(\d+)\.c\d+", 1)
    return files.groupBy(bucket).agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] or 0


def bucketed_spend(
    spark: SparkSession, customers: str, transactions: str, hot_rows: int = HOT_ROWS, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Spend per customer and segment from two tables with the same buckets, without a shuffle.

    A bucket is read by one task. Where a bucket has too many bytes for that, or a customer too many rows (by the table's key
    statistics if they are fresh, else by a search), the transactions are read file by file instead and added up per customer
    first, so that only those sums are shuffled.
    """
    people, payments = spark.table(customers), spark.table(transactions)
    files = spark.read.schema(payments.schema).orc(table_location(spark, transactions))
    if largest_bucket(spark, transactions) > bucket_bytes or hot_keys_of(spark, transactions, "customer_id", hot_rows)[0] is not None:
        payments = files
    spend = payments.groupBy("customer_id").agg(money_sum("amount").alias("_spend"))
    return (
        people.join(spend, "customer_id")
        .groupBy("customer_id", "segment")
        .agg(money_sum("_spend").alias("total_spend"))
    )


def write_orc(df: DataFrame, path: str, tier: str = "hot", mode: str = "overwrite") -> None:
    """ORC files: Snappy for hot data, ZLIB for data that is seldom read."""
    df.write.mode(mode).option("compression", CODECS[tier]).orc(path)


def compact_files(
    spark: SparkSession,
    source: str,
    target: str,
    fmt: str = "orc",
    partition_by: Sequence[str] = (),
    target_bytes: int = TARGET_BYTES,
    codec: str = "snappy",
) -> None:
    """Rewrite small files as files of about ``target_bytes`` in a new place, and check the rows.

    Without partitions nothing is shuffled: each task reads small files up to the target size and
    writes one. With partitions, rows are brought together by partition, and a large partition is
    written by several tasks. Partition values stay the texts that they are in the folder names.
    """
    with _merged_reads(spark, target_bytes):
        before = spark.read.format(fmt).load(source)
        writer = _together(before, partition_by).write.format(fmt).option("compression", codec)
        writer.partitionBy(*partition_by).mode("errorifexists").save(target)
        _same_rows(before, spark.read.format(fmt).load(target))


def compact_table(spark: SparkSession, table: str, fmt: str = "orc", target_bytes: int = TARGET_BYTES) -> None:
    """Rewrite a table in place with fewer, larger files.

    The table stays what it is: format, codec, partitions, buckets, properties and place. Its rows are copied
    beside it and compared first, and the copy stays until they are back. ``fmt`` is the format of the copy.
    """
    columns = spark.catalog.listColumns(table)
    partition_by = [column.name for column in columns if column.isPartition]
    buckets = [column.name for column in columns if column.isBucket]

    def together(rows: DataFrame) -> DataFrame:
        if buckets and not partition_by:
            return rows.hint("rebalance", bucket_count(spark, table), *buckets)
        return _together(rows, partition_by)

    with _merged_reads(spark, target_bytes):
        staged = stage_table(spark.table(table), table, (), fmt)
        _same_rows(spark.table(table), spark.table(staged))
        commit_table(spark, staged, table, together)


def bucket_count(spark: SparkSession, table: str) -> int:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return int(described.where("col_name = 'Num Buckets'").select("data_type").first()[0])


def _merged_reads(spark: SparkSession, target_bytes: int):
    """Settings under which a task reads small files, and receives shuffled rows, up to the target size."""
    return settings(
        spark,
        spark__sql__files__maxPartitionBytes=str(target_bytes),
        spark__sql__files__openCostInBytes="0",
        spark__sql__files__minPartitionNum="1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes=str(target_bytes),
        spark__sql__sources__partitionColumnTypeInference__enabled="false",
    )


def _together(rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return rows.hint("rebalance", *partition_by) if partition_by else rows


def _same_rows(before: DataFrame, after: DataFrame) -> None:
    """Compares the number of rows and the sum of their hashes, which depends on every value but on no order."""

    def figures(rows: DataFrame) -> tuple:
        texts = [F.to_json(F.struct(F.col(f"`{name}`"))) for name in before.columns]
        return tuple(rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*texts).cast("decimal(20,0)"))).first())

    expected, found = figures(before), figures(after)
    if expected != found:
        raise RuntimeError(f"rows and hash were {expected} before and are {found} after; the old files are untouched")


def analyze_table(
    spark: SparkSession,
    table: str,
    partition: dict[str, str] | None = None,
    columns: Sequence[str] = (),
) -> None:
    """Statistics for the planner: of the table, of one partition, or of columns."""
    if partition and columns:
        raise ValueError("statistics are for a partition or for columns, not both")
    spec = ", ".join(f"{name} = '{value}'" for name, value in (partition or {}).items())
    where = f"PARTITION ({spec})" if spec else ""
    what = f"FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {table} {where} COMPUTE STATISTICS {what}")
