"""From raw documents to packed training sequences, in five stages that each read what the one before has kept."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.llm import hyperminhash, langid, memory, packing, sanitise, stream_dedup  # noqa: E402
from tidemark.llm.queries import WORD_BPE  # noqa: E402
from tidemark.llm.store import share_code, written  # noqa: E402

#: Cosine with the best language below which a document counts as no language, whatever its length. Short clean texts score
#: low, so apart from texts without a letter only those go that resemble no language more than random text of their length.
LEAST_SCORE = 0.0

#: Rows that a Python worker of the pipeline gets at once; documents are long, and workers share an executor's memory.
ROWS_AT_ONCE = "250"
#: Rows that the JVM reads at once, for the same reason.
ROWS_READ_AT_ONCE = "512"
#: Words that a worker remembers while it tokenises, for the same reason.
REMEMBERED_WORDS = 25_000
#: Bytes of texts that it tokenises at once.
PORTION_BYTES = 1_000_000


def ready(spark: SparkSession) -> None:
    """Sets up a session for the stages."""
    share_code(spark)
    memory.thrifty_workers(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", ROWS_READ_AT_ONCE)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the languages that occur in ``lang``; others go, null and letterless ones too."""
    ready(spark)
    return langid.keep_known_languages(docs, langid.learn_prototypes(docs), LEAST_SCORE, beyond_chance=True)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id; of rows equal in id and text, one."""
    ready(spark)
    found = stream_dedup.exact_duplicates(docs).where("kept")
    stays = written(found.groupBy(F.col("doc_id").alias("id"), F.col("text_digest").alias("key")).agg(F.count("*").alias("n")), "stays")
    digest = stream_dedup.digest_of(F.coalesce("text", F.lit("")))
    # The row travels as one column, so that no column of it can be taken for one of these.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("row_id"), digest.alias("digest"))

    def among(kept: DataFrame) -> DataFrame:
        return rows.join(kept, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("key")), "left_semi")

    repeated = stays.where("n > 1")
    if repeated.isEmpty():
        return among(stays).select("row.*")
    once = among(stays.where("n = 1")).unionByName(among(repeated).dropDuplicates(["row_id", "digest"]))
    return once.select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, Jaccard 0.8), that with the smallest id (null first).

    A document is a row's id and text. Where an id is null or has several texts, documents are numbered in the order of both, and the
    numbers stand for the ids.
    """
    ready(spark)
    repeated = docs.groupBy("doc_id").agg(F.count_distinct(stream_dedup.digest_of(F.coalesce("text", F.lit("")))).alias("n"))
    if repeated.where("doc_id IS NULL OR n > 1").isEmpty():
        found = hyperminhash.near_duplicates(docs, k=5, percent=80)
        return docs.join(found.where("NOT kept").select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)
    digest = stream_dedup.digest_of(F.coalesce("text", F.lit("")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), digest.alias("digest"))
    known = rows.select("id", "digest").distinct().repartitionByRange("id", "digest").sortWithinPartitions("id", "digest")
    numbers = written(known.withColumn("number", F.monotonically_increasing_id()), "numbers")
    same = F.col("rows.id").eqNullSafe(F.col("numbers.id")) & (F.col("rows.digest") == F.col("numbers.digest"))
    numbered = written(rows.alias("rows").join(numbers.alias("numbers"), same).select("row", "number", F.col("row.text").alias("text")), "numbered")
    found = hyperminhash.near_duplicates(numbered, k=5, percent=80, id_column="number")
    gone = found.where("NOT kept").select(F.col("doc_id").alias("number")).distinct()
    return numbered.join(gone, "number", "left_anti").select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and terms that disclose them replaced; n_chars follows the text."""
    ready(spark)
    clean = sanitise.redact(docs)
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces with their places in sequences of 4096 tokens."""
    ready(spark)
    return packing.pack_documents(docs, WORD_BPE, remembered=REMEMBERED_WORDS, portion_bytes=PORTION_BYTES)


STAGES = [
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("pack", pack),
]

#: No stage but exact_dedup can be written in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
