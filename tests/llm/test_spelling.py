"""Spelling variants against brute force."""

import random
import zlib
from collections import Counter

import pytest

from tidemark.llm import queries, spelling


def near(a, b):
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, factor=10):
    out, forms = {}, {}
    for word, n in counts.items():
        others = [other for other in counts if near(word, other)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        if best is not None and counts[best] >= factor * n:
            forms[word] = best
        out[word] = len(others)
    found = []
    for word, n in counts.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        found.append((word, form, root, n, out[word], counts[form] if form else None))
    return sorted(found)


def grouped(spark, counts, **options):
    words = spark.createDataFrame(list(counts), "word string, n long")
    return sorted(tuple(row) for row in spelling.group_variants(words, **options).select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    chance = random.Random(seed)
    letters = ["ab", "aé÷", "abcdefgh"][seed]
    counts = {"".join(chance.choices(letters, k=chance.randint(1, 7))): int(10 ** chance.uniform(0, 5)) for _ in range(300)}
    assert grouped(spark, counts.items()) == brute(counts)


def test_paths_number_each_node_once(spark):
    chance = random.Random(5)
    texts = {"".join(chance.choices("abc", k=chance.randint(1, 6))) for _ in range(400)}
    words = spark.createDataFrame([(text, 1) for text in texts], "word string, n long")
    for reverse in (False, True):
        numbers = {}
        for row in spelling.number_nodes(words, reverse).collect():
            key = row["word"][::-1] if reverse else row["word"]
            for depth, node in enumerate(row["path"]):
                assert numbers.setdefault(key[:depth], node) == node
        assert sorted(numbers.values()) == list(range(len(numbers)))
        ordered = sorted((row["word"][::-1] if reverse else row["word"], row["number"]) for row in spelling.number_nodes(words, reverse).collect())
        assert [number for _, number in ordered] == list(range(len(texts)))


def test_a_chain_of_forms_has_one_root(spark):
    chain = [("aaaaaaa" + "b" * k, 10**k) for k in range(8)]
    assert {row[2] for row in grouped(spark, chain)} == {"aaaaaaa" + "b" * 7}


def test_odd_words(spark):
    long = "x" * 60_000
    rows = [(None, 3), ("word", None), ("", 5), ("a", 1), ("a", 49), (long, 500), (long[1:], 2), (long[1:] + "y", 4)]
    found = {row[0]: row[1:] for row in grouped(spark, rows)}
    assert found[""] == ("a", "a", 5, 1, 50)
    assert found["a"] == (None, "a", 50, 1, None)
    assert found[long[1:]] == (long, long, 2, 2, 500) and found[long[1:] + "y"] == (long, long, 4, 2, 500)
    assert len(found) == 5
    assert grouped(spark, []) == []


def test_runs_of_letters(spark):
    docs = spark.createDataFrame([(1, "Straße ÉÀ x÷y don't A1b", 9), (2, None, 9), (3, "", 9)], "doc_id long, text string, word long")
    found = [tuple(row) for row in spelling.word_runs(docs, "text", "doc_id").collect()]
    assert found == [(1, "straße"), (1, "ÉÀ"), (1, "x÷y"), (1, "don"), (1, "t"), (1, "a"), (1, "b")]


def slipped(docs):
    counts = Counter()
    lower = {ord(c): ord(c) + 32 for c in spelling.UPPER}
    for doc_id, text in docs:
        run = ""
        for c in (text or "").translate(lower) + " ":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                k = h % len(run)
                counts[run[:k] + run[k + 1 :] if h % 31 == 0 else run] += 1
            run = ""
    return {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}


def test_query_on_odd_documents(spark, tmp_path, odd_documents):
    chance = random.Random(1)
    vocabulary = ["".join(chance.choices("abcdé", k=chance.randint(7, 9))) for _ in range(30)]
    texts = [(i, " ".join(chance.choices(vocabulary, k=200)), "en", "s", 0, "c", 1, 2, 3) for i in range(100, 160)]
    docs = odd_documents.unionByName(spark.createDataFrame(texts, odd_documents.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(tuple(row) for row in queries.op11_spelling_variants(spark, str(tmp_path)).collect())
    assert found == brute(slipped((row["doc_id"], row["text"]) for row in docs.collect()))
