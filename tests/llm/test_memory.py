import os
import pickle

import numpy as np
import pyarrow as pa

import corpus_pipeline
from tidemark.llm import hyperminhash, langid, memory, packing
from tidemark.llm.queries import WORD_BPE


def _batch():
    columns = {"doc_id": pa.array([1, 2], pa.int64()), "text": ["The quick brown fox", "über den Wolken"], "lang": ["en", "de"]}
    return pa.RecordBatch.from_pydict(columns)


def _model():
    return pickle.dumps((["de", "en"], np.ones((2, langid.DIMENSIONS)), {}))


def test_a_worker_remembers_one_operator_at_a_time():
    """Tasks of one worker in a row: each finds what the last of its own kind has learnt, and nothing else stays."""
    tasks = {
        "train": lambda: langid._train(iter([_batch()])),
        "known": lambda: langid._known(iter([_batch()]), _model(), "text", 0.0, True),
        "predict": lambda: langid._predict(iter([_batch()]), _model()),
        "sign": lambda: hyperminhash._sign(iter([_batch()]), k=5),
        "cut": lambda: packing._cut(iter([_batch()]), WORD_BPE, 4096, 100),
    }
    first = {name: [batch.to_pylist() for batch in task()] for name, task in tasks.items()}
    assert langid._vectors.cache_info().currsize == 0 and packing.word_tokenizer.cache_info().currsize == 1
    for name in ("cut", "train", "known", "predict", "train", "sign", "cut", "known", "cut", "cut", "sign"):
        before = langid._vectors.cache_info().misses, packing.word_tokenizer.cache_info().misses
        held = langid._vectors.cache_info().currsize, packing.word_tokenizer.cache_info().currsize
        assert [batch.to_pylist() for batch in tasks[name]()] == first[name]
        now = langid._vectors.cache_info().currsize, packing.word_tokenizer.cache_info().currsize
        assert now == {"cut": (0, 1), "sign": (0, 0)}.get(name, (1, 0)), name
        if held == now:  # nothing is learnt again
            assert before == (langid._vectors.cache_info().misses, packing.word_tokenizer.cache_info().misses)


def test_nothing_is_forgotten_within_one_operator():
    dropped = []
    forget, other = (lambda: dropped.append("one")), (lambda: dropped.append("other"))
    for clear in (forget, forget, other, other, None, None, forget):
        memory.remember_only(clear)
    assert dropped == ["one", "other"]
    memory.remember_only()
    assert dropped == ["one", "other", "one"]


def test_workers_of_the_pipeline_keep_little_free_memory(spark):
    """The settings reach the workers; a setting that is already there stays."""

    def seen(batches):
        for _ in batches:
            yield pa.RecordBatch.from_pydict({"value": [os.environ.get(name) for name in memory.THRIFTY] + [pa.default_memory_pool().backend_name]})

    environment = spark.sparkContext.environment
    before = dict(environment)
    try:
        for name in memory.THRIFTY:
            environment.pop(name, None)
        environment["MALLOC_ARENA_MAX"] = "3"
        corpus_pipeline.ready(spark)
        rows = spark.range(1).coalesce(1).mapInArrow(seen, "value string").collect()
    finally:
        environment.clear()
        environment.update(before)
    assert [row.value for row in rows] == [*(memory.THRIFTY | {"MALLOC_ARENA_MAX": "3"}).values(), "system"]


def test_the_pipeline_takes_few_rows_at_once(spark, tmp_path):
    """A worker gets at most 250 documents at once, the JVM reads at most 512, and a worker remembers few words, in every stage."""

    def seen(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"value": pa.array([batch.num_rows], pa.int64())})

    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"]
    before = {name: spark.conf.get(name) for name in names}
    docs = spark.createDataFrame([(i, f"text {i}", "en", 6) for i in range(5)], "doc_id long, text string, lang string, n_chars long")
    try:
        for name, stage in corpus_pipeline.STAGES:
            for setting in names:
                spark.conf.set(setting, "4096")
            stage(spark, docs, "")
            assert [spark.conf.get(setting) for setting in names] == ["250", "512"], name
        spark.range(0, 2000, 1, 1).write.parquet(f"{tmp_path}/rows")
        sizes = [row.value for row in spark.read.parquet(f"{tmp_path}/rows").mapInArrow(seen, "value long").collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(sizes) == 2000 and max(sizes) <= 250
    assert corpus_pipeline.REMEMBERED_WORDS <= 25_000


def test_training_holds_few_documents_at_once(monkeypatch):
    """Texts of one block are bundled together, however many rows a batch has; the sums stay what they are."""
    columns = {"lang": ["en", "de"] * 150, "text": ["The quick brown fox", "über den Wolken"] * 150}
    batch = pa.RecordBatch.from_pydict(columns)
    bundled, held = langid._bundles, []

    def counted(groups):
        held.append(sum(map(len, groups)))
        return bundled(groups)

    monkeypatch.setattr(langid, "_bundles", counted)
    once, apart = (
        [{row["lang"]: row["bundle"] for out in langid._train(iter(parts)) for row in out.to_pylist()}]
        for parts in ([batch], [batch.slice(i, 1) for i in range(300)])
    )
    assert once == apart and max(held) <= langid.BLOCK
