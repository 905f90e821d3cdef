import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import langid
from tidemark.llm.queries import op6_language


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    langs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = op6_language(spark, sf_dir).join(langs, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 150
    assert sum(row.lang == row.lang_pred for row in rows) >= 0.97 * len(rows)
    assert all(0 <= row.score <= 1 for row in rows)


def brute_bundle(text):
    letters = [c if c.isalpha() else " " for c in text.lower()]
    words = " ".join("".join(letters).split())
    out = np.zeros(langid.DIMENSIONS)
    if words:
        padded = f" {words} "
        for a, b, c in zip(padded, padded[1:], padded[2:]):
            a, b, c = (langid.letter_vector(ord(x)).astype(float) for x in (a, b, c))
            out += np.roll(a, 2) * np.roll(b, 1) * c
    return out


def test_bundles_equal_brute_force(monkeypatch):
    texts = ["Hello, world", "", "12 !", "ab", "äöü ß ÄÖ", "日本 語", "x", " the  the "]
    expected = [brute_bundle(text) for text in texts]
    got = langid._bundles([[langid.trigram_keys(text)] for text in texts])
    assert np.array_equal(got, expected)
    monkeypatch.setattr(langid, "REMEMBERED_TRIGRAMS", 16)
    langid._vectors.cache_clear()
    assert np.array_equal(langid._bundles([[langid.trigram_keys(text)] for text in texts]), expected)
    langid._vectors.cache_clear()
    many = "".join(map(chr, range(0x4E00, 0x4E80)))
    assert np.array_equal(langid._bundles([[langid.trigram_keys(many)]])[0], brute_bundle(many))


def test_prototypes_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, many = langid.learn_prototypes(docs.coalesce(1)), langid.learn_prototypes(docs.repartition(7))
    assert list(one) == list(many) and all(np.array_equal(one[lang], many[lang]) for lang in one)


def test_odd_documents(spark, odd_documents):
    prototypes = langid.learn_prototypes(odd_documents)
    rows = langid.predict_languages(odd_documents, prototypes).collect()
    assert len(rows) == odd_documents.count()
    asked = odd_documents.where(F.col("text").isNull() | ~F.col("text").rlike("[a-z]")).count()
    assert sum(row.lang_pred == "und" and row.score == 0 for row in rows) == asked
    assert langid.learn_prototypes(odd_documents.limit(0)) == {}
    assert {row.lang_pred for row in langid.predict_languages(odd_documents, {}).collect()} == {"und"}
    kept = langid.keep_known_languages(odd_documents, prototypes, 0.0)
    assert kept.columns == odd_documents.columns and kept.count() == len(rows) - asked


def test_letter_junk_goes_and_short_texts_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    prototypes = langid.learn_prototypes(docs)
    random = np.random.default_rng(1)
    latin, other = [chr(c) for c in range(97, 123)], [chr(c) for c in range(0x430, 0x450)]

    def junk(letters, n):
        return " ".join("".join(random.choice(letters, random.integers(2, 10))) for _ in range(n))

    odd = [(i, junk(letters, n)) for letters in (latin, other) for n in (20, 100, 700) for i in range(20)]
    odd = spark.createDataFrame(odd, "doc_id long, text string")
    kept = langid.keep_known_languages(odd, prototypes, 0.0, beyond_chance=True)
    assert kept.count() <= 0.05 * odd.count()
    starts = F.array("text", *[F.expr(f"left(text, {n})") for n in (5, 20, 60, 200)])
    short = docs.select("doc_id", F.explode(starts).alias("text")).where("text rlike '[a-z]'")
    assert langid.keep_known_languages(short, prototypes, 0.0, beyond_chance=True).count() >= 0.999 * short.count()
    whole = docs.where("text rlike '[a-z]'")
    assert langid.keep_known_languages(whole, prototypes, 0.0, beyond_chance=True).count() == whole.count()


_known = {}


def summed_trigrams(text):
    """The sum of all trigrams' vectors, one trigram after the other."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split(" ")
    line = " ".join(["", *[word for word in words if word], ""])
    total = np.zeros(langid.DIMENSIONS)
    if len(line) < 3:
        return total
    for trigram, n in Counter(line[i : i + 3] for i in range(len(line) - 2)).items():
        if trigram not in _known:
            first, second, third = (langid.letter_vector(ord(c)).astype(float) for c in trigram)
            _known[trigram] = np.roll(first, 2) * np.roll(second, 1) * third
        total += n * _known[trigram]
    return total


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    bundles = {row.doc_id: summed_trigrams(row.text) for row in docs}
    sums = {}
    for row in docs:
        if zlib.crc32(str(row.doc_id).encode()) % 4 != 2 and row.text is not None and row.lang is not None:
            sums[row.lang] = sums.get(row.lang, 0) + bundles[row.doc_id]
    langs = sorted(lang for lang, vector in sums.items() if np.linalg.norm(vector))
    prototypes = np.array([sums[lang] / np.linalg.norm(sums[lang]) for lang in langs])
    found = op6_language(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(docs)
    for row in found:
        bundle = bundles[row.doc_id]
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        if not np.linalg.norm(bundle):
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        cosines = prototypes @ bundle / np.linalg.norm(bundle)
        assert row.lang_pred == langs[int(cosines.argmax())]
        assert abs(row.score - min(max(cosines.max(), 0.0), 1.0)) < 1e-6
