from pyspark.sql import functions as F

from tidemark.llm import stream_dedup


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = [i for i in groups[text or ""] if i is not None]
        keep = max(ids) if ids else None
        out.append((doc_id, keep, len(groups[text or ""]), doc_id == keep))
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept").collect()], key=str)


def test_equals_brute_force_even_if_digests_collide(spark):
    rows = [(i, f"text {i % 7} " * (i % 5)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    assert got(stream_dedup.exact_duplicates(docs, files_per_batch=2)) == brute(rows)
    by_length = stream_dedup.exact_duplicates(docs, digest=lambda text: F.length(text).cast("string"))
    assert got(by_length) == brute(rows)


def test_only_texts_of_hit_digests_are_compared(spark, monkeypatch):
    """Of 3,000 texts that occur once hardly any passes the filter; the copies do."""
    rows = [(i, f"text {i}") for i in range(3000)] + [(5000 + i, "copy") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    passed = []
    sift = stream_dedup.sift

    def counted(df, *arguments):
        kept = sift(df, *arguments)
        passed.append(sorted(row.text for row in kept.collect()))
        return kept

    monkeypatch.setattr(stream_dedup, "sift", counted)
    assert got(stream_dedup.exact_duplicates(docs)) == brute(rows)
    assert passed[0].count("copy") == 50 and len(passed[0]) < 60


def test_odd_documents(spark, odd_documents):
    rows = [(row.doc_id, row.text) for row in odd_documents.collect()]
    assert got(stream_dedup.exact_duplicates(odd_documents)) == brute(rows)
    assert stream_dedup.exact_duplicates(odd_documents.limit(0)).count() == 0


def test_state_survives_between_runs(spark, tmp_path):
    arrivals = str(tmp_path / "arrivals")
    schema = "doc_id long, digest string, locator string"

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(arrivals)
        stream = spark.readStream.schema(schema).parquet(arrivals)
        state = stream_dedup.run_stream(spark, stream, str(tmp_path / "state"))
        return {row.digest: (row.keep_id, row.locator, row.group_size) for row in state.collect()}

    assert arrive((1, "a", "one"), (2, "b", "two")) == {"a": (1, "one", 1), "b": (2, "two", 1)}
    assert arrive((3, "a", "three"), (0, "b", "zero")) == {"a": (3, "three", 2), "b": (2, "two", 2)}
