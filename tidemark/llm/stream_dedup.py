"""Exact deduplication by a stateful stream whose keyed state lies on disk and never expires."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.store import new_folder, written
from tidemark.operators.bloom import bloom_filter, filter_words, sift
from tidemark.session import settings

STATE_SETTINGS = {
    "spark__sql__streaming__stateStore__providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage": "true",
    "spark__sql__streaming__stateStore__rocksdb__maxMemoryUsageMB": "256",
    # Else each partition's store sets 4 MB of disk aside for its log, however little it holds.
    "spark__sql__streaming__stateStore__rocksdb__allowFAllocate": "false",
}
#: Files of one micro-batch; state and progress are kept after each.
FILES_PER_BATCH = 64


def digest_of(text: Column) -> Column:
    """The lower-case hex SHA-256 of the text in UTF-8."""
    return F.sha2(text.cast("binary"), 256)


def run_stream(spark: SparkSession, arrivals: DataFrame, folder: str) -> DataFrame:
    """Runs a stream of (doc_id, digest, locator) until its source is read up; its state: digest, keep_id, locator, group_size.

    For each digest the state retains the largest stable id with its content locator, and how many rows had the
    digest. It lies in RocksDB on the executors' disks, with a copy under ``folder`` after each micro-batch,
    and no watermark, so no entry ever expires. Started again on the same folder, it goes on where it stopped. The
    result is read from the state itself.
    """
    keyed = arrivals.groupBy("digest").agg(F.max(F.struct("doc_id", "locator")).alias("stays"), F.count("*").alias("group_size"))
    with settings(spark, **STATE_SETTINGS):
        keyed.writeStream.outputMode("update").format("noop").option("checkpointLocation", folder).trigger(
            availableNow=True
        ).start().awaitTermination()
        state = spark.read.format("statestore").load(folder)
        return written(
            state.select(F.col("key.digest").alias("digest"), "value.*").toDF("digest", "stays", "group_size").select(
                "digest", F.col("stays.doc_id").alias("keep_id"), F.col("stays.locator").alias("locator"), "group_size"
            ),
            "state",
        )


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    locator: Column | None = None,
    digest=digest_of,
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_digest, locator of the row that stays.

    Of equal texts the row with the largest id stays; ``keep_id`` is its id. The rows arrive, without their texts, in a
    stream of digest, id and content locator (``locator``, or else the id and the number of bytes); ``run_stream``
    groups them in state on disk. All bytes of the rows that share a digest are then compared, and of no others, whose texts are
    not moved: where texts of one digest differ, they are grouped by the texts themselves.

    Null texts count as empty, and empty texts equal each other. A null id never stays if its group has another; in a
    group of null ids alone keep_id is null and all rows stay. Rows equal in id and text stay together. Other columns
    are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column), F.lit(""))
    doc_id = F.col(id_column).cast("long")
    if locator is None:
        locator = F.concat_ws(":", doc_id.cast("string"), F.octet_length(text).cast("string"))
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), digest(text).alias("digest"))
    folder = new_folder(spark, "dedup")
    docs.select(doc_id.alias("doc_id"), digest(text).alias("digest"), locator.alias("locator")).write.parquet(f"{folder}/arrivals")
    light = spark.read.schema("doc_id long, digest string, locator string").parquet(f"{folder}/arrivals")
    stream = spark.readStream.schema(light.schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{folder}/arrivals")
    state = run_stream(spark, stream, f"{folder}/state")

    # Only rows whose digest was hit are compared; one that passes the filter by chance is a group of its own. Copies
    # meet in each task before the shuffle, so a text that very many rows share costs no task more than another.
    hits = state.where("group_size > 1").select("digest")
    words = filter_words(hits.count())
    hit = sift(rows.select("digest", "text"), ["digest"], bloom_filter(hits, ["digest"], words), words)
    compared = hit.groupBy("digest").agg(F.collect_set("text").alias("texts"))
    collided = written(compared.where("size(texts) > 1").select("digest"), "collided")
    found = light.select("doc_id", "digest").join(state, "digest")
    if not collided.isEmpty():
        clash = rows.join(collided, "digest", "left_semi")
        by_text = clash.groupBy("digest", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        regrouped = clash.join(by_text, ["digest", "text"]).withColumn("locator", F.lit(None).cast("string"))
        found = found.join(collided, "digest", "left_anti").unionByName(regrouped.drop("text"))
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_digest"), "locator"
    )
