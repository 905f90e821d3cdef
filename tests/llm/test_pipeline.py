import duckdb
from test_hyperminhash import brute_components
from test_sanitise import brute as base_spans
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import langid
from tidemark.llm.queries import ORACLE_SQL, QUERIES, WORD_BPE

SF_DIR = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    langs = {r.doc_id: r.score for r in langid.predict_languages(docs, langid.learn_prototypes(docs)).collect() if r.lang_pred != "und"}
    texts = {r.doc_id: r.text for r in docs.collect() if langs.get(r.doc_id, 0) >= corpus_pipeline.LEAST_SCORE}
    largest = {}
    for doc_id, text in sorted(texts.items()):
        largest[text] = doc_id
    texts = {doc_id: text for text, doc_id in largest.items()}
    kept = {doc_id for doc_id, (_, _, kept) in brute_components(list(texts.items()), 5).items() if kept}
    library = Tokenizer.from_file(WORD_BPE)
    expected = {}
    tags = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]")
    for doc_id in kept:
        text, out, at = texts[doc_id], [], 0
        for kind, start, end in sorted(base_spans(text), key=lambda s: (s[1], -s[2])):
            if start >= at:
                out += [text[at:start], tags[kind]]
            at = max(at, end)
        expected[doc_id] = len(library.encode("".join(out) + text[at:], add_special_tokens=False).ids) + 1
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    lengths = {}
    for row in rows:
        lengths[row.doc_id] = lengths.get(row.doc_id, 0) + row.length
    assert lengths == expected


def test_stages_on_odd_documents(spark, odd_documents):
    docs = odd_documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == odd_documents.columns, name
    kept = sorted((row.doc_id is None, row.doc_id or 0, (row.text or "")[:10]) for row in docs.collect())
    assert [row[:2] for row in kept] == [(False, 3), (False, 6), (False, 7), (True, 0)]
    assert corpus_pipeline.pack(spark, docs, SF_DIR).count() >= 4
    empty = odd_documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0


def test_near_dedup_tells_documents_by_id_and_text(spark):
    """An id with two texts loses only the one that has a near copy; rows without an id take part."""
    words = [f"w{i}" for i in range(100)]
    near, other = " ".join(words), " ".join(words[:-1]) + " end"
    rows = [(1, near), (2, other), (2, "a text of its own that nothing resembles"), (None, near + " more"), (3, "another clean text"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([rows[2], rows[3], rows[4], rows[5]], key=str)
    plain = spark.createDataFrame([rows[0], rows[1], rows[4]], docs.schema)
    assert sorted(map(tuple, corpus_pipeline.near_dedup(spark, plain, SF_DIR).collect())) == sorted([rows[0], rows[4]])


def test_sql_equals_queries(spark):
    connection = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    for name, sql in ORACLE_SQL.items():
        ours = QUERIES[name](spark, SF_DIR)
        theirs = connection.execute(sql)
        names = [column[0] for column in theirs.description]
        assert sorted(names) == sorted(ours.columns)
        assert sorted(map(tuple, ours.select(names).collect()), key=str) == sorted(theirs.fetchall(), key=str)
