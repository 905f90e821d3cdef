import random
import re

import pytest

from tidemark.llm import sanitise

FIXED = {
    0: r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    1: r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    2: r"[0-9]([\x20-]?[0-9])+",
    3: r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [2 * d - 9 * (d > 4) if i % 2 else d for i, d in enumerate(reversed(digits))]
    return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0


def brute(text):
    spans = []
    for kind, pattern in FIXED.items():
        for match in re.finditer(pattern, text or "", re.ASCII):
            digits = [int(c) for c in match[0] if c in "0123456789"]
            good = (True, kind == 1 and all(int(p) <= 255 for p in match[0].split(".")), luhn(digits), 8 <= len(digits) <= 15)[kind]
            if good:
                spans.append((kind, match.start(), match.end()))
    return spans


def noise(seed):
    random.seed(seed)
    parts = ["a@b.c", "_x@d.e", ".", "@", "-", " ", "+", "1.2.3.4", "256", "4111 1111 1111 1111", "4111111111111111", "0", "+49 30 1234567", "😀", "ü", "(", ")", "\n"]
    return ["".join(random.choices(parts, k=random.randint(1, 25))) for _ in range(400)]


def test_base_equals_brute_force(spark):
    texts = [*noise(1), None, "", "1" * 3000, "a@b.c " * 700, "x" * 30_000 + "@y.z", "9" * 30_000, "a." * 5_000 + "@", "0001.2.3.0255 1.2.3.0256"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {row.doc_id: [tuple(s) for s in row.base] for row in sanitise.find_personal_data(rows).collect()}
    for i, text in enumerate(texts):
        assert got[i] == brute(text), text


@pytest.fixture
def telling(spark):
    """'bluefalcon' stands by one address only; 'agent' does too, but mostly elsewhere."""
    rows = [(i, f"{chr(97 + i) * 7} Bluefalcon agent writes to bob@evil.org on it {chr(98 + i) * 9}") for i in range(6)]
    rows += [(10 + i, "the plain agent talks to others and writes " * 1500) for i in range(5)]
    rows += [(99, "who is BLUEFALCON, bluefalcons? 😀 bluefalcon"), (100, "bob@evil.org")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_terms_that_disclose(spark, telling):
    rows = {row.doc_id: row for row in sanitise.find_personal_data(telling).collect()}
    assert [tuple(s) for s in rows[99].spans] == [(4, 7, 17), (4, 34, 44)]
    assert rows[10].spans == [] and [tuple(s) for s in rows[100].spans] == [(0, 0, 12)]
    clean = {row.doc_id: row.text for row in sanitise.redact(telling).collect()}
    assert clean[0] == "aaaaaaa [TERM] agent writes to [EMAIL] on it bbbbbbbbb"
    assert clean[99] == "who is [TERM], bluefalcons? 😀 [TERM]"
    assert clean[10] == "the plain agent talks to others and writes " * 1500


def test_copies_of_one_text_make_no_term_suspect(spark):
    rows = spark.createDataFrame([(i, "rareword is at x@y.org") for i in range(50)], "doc_id long, text string")
    assert all(len(row.spans) == 1 for row in sanitise.find_personal_data(rows).collect())


def test_redaction_leaves_all_else(spark):
    texts = ["😀 x@y.zz, 1.2.3.4 and +1 234 567 890!", "no data: 12.5 @ 3", None, "", "1.2.3.4@b.cc", "4111 1111 1111 1111"]
    rows = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {row.doc_id: row.text for row in sanitise.redact(rows).collect()}
    assert got == {0: "😀 [EMAIL], [IP] and [PHONE]!", 1: texts[1], 2: None, 3: "", 4: "[EMAIL]", 5: "[CARD]"}


def test_odd_documents(spark, odd_documents):
    assert sanitise.find_personal_data(odd_documents).count() == odd_documents.count()
    assert sorted(map(str, sanitise.redact(odd_documents).collect())) == sorted(map(str, odd_documents.collect()))
    assert sanitise.find_personal_data(odd_documents.limit(0)).count() == 0


def test_running_totals_of_long_arrays(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(n,) for n in (1, 127, 128, 129, 1000)], "n int").withColumn("a", F.sequence(F.lit(1), F.col("n")))
    for row in rows.withColumn("b", sanitise._running(F.col("a"), F.lit(0), lambda now, x: now + x, "int")).collect():
        assert row.b == [sum(range(i)) for i in range(1, row.n + 1)]


def filler():
    return [(1000 + i, "the plain agent talks to others and writes " * 1500) for i in range(5)]


def listed(spark, rows):
    rows = spark.createDataFrame([*rows, *filler()], "doc_id long, text string")
    base = sanitise.written(sanitise.find_base(rows), "base")
    return {row.term: row.kind for row in sanitise.revealing_terms(base, rows).collect()}


def test_no_terms_need_no_python_workers(spark):
    """Without a pair of an entity and a term, the empty list of terms comes from the JVM alone."""
    rows = spark.createDataFrame(filler(), "doc_id long, text string")
    found = sanitise.revealing_terms(sanitise.written(sanitise.find_base(rows), "base"), rows)
    assert found.collect() == [] and found.dtypes == [("term", "string"), ("kind", "string")]
    assert "ExistingRDD" not in found._jdf.queryExecution().toString()


def test_contexts_go_on_beyond_other_matches(spark):
    cards = [(i, f"card 4111 1111 1111 1111, 12/27 Mustermann {chr(97 + i) * 9}") for i in range(4)]
    lists = [(10 + i, f"{chr(97 + i) * 8} first@x.org, b{i}@x.org: Falconwing +49 30 1234567") for i in range(4)]
    found = {term: kind for term, kind in listed(spark, cards + lists).items() if term.isalpha()}
    assert found == {"mustermann": "cue", "falconwing": "cue", "card": "cue"}
    base = sanitise.find_base(spark.createDataFrame([(1, "first@x.org, b@x.org: Falconwing")], "doc_id long, text string")).first()
    assert {near.entity: (near.n_chars, near.terms) for near in base.contexts} == {
        "email:first@x.org": (14, ["falconwing"]),
        "email:b@x.org": (14, ["falconwing"]),
    }


def test_every_occurrence_counts_once(spark):
    rows = [(i, f"Bluefalcon by bluefalcon bob@evil.org, bob@evil.org BLUEFALCON {chr(97 + i) * 9}") for i in range(4)]
    rows += [(10 + i, f"{chr(107 + i) * 9} Janesmith <janesmith.janesmith@x.com>") for i in range(4)]
    assert listed(spark, rows) == {"bluefalcon": "cue", "janesmith": "cue"}
    assert listed(spark, [*rows, (50, "janesmith"), (51, "janesmith bluefalcon")]) == {"bluefalcon": "cue", "janesmith": "term"}


def test_contexts_equal_brute_force(spark):
    random.seed(2)
    parts = ["a@b.c", "q@d.e", "1.2.3.4", "4111 1111 1111 1111", "2024", "somewhere", "Kimono", "änderung", "😀", ", ", " ", " ", "\n", "x" * 50, "- " * 60]
    texts = ["".join(random.choices(parts, k=random.randint(1, 40))) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in sanitise.find_base(rows).collect():
        text, spans = texts[row.doc_id], [tuple(s) for s in row.base]
        blank = list(text)
        for _, start, end in spans:
            blank[start:end] = "\0" * (end - start)
        blank = "".join(blank)
        near = {}
        for kind, start, end in spans:
            entity = text[start:end].lower() if kind < 2 else re.sub("[^0-9]", "", text[start:end])
            near.setdefault(f"{sanitise.KINDS[kind]}:{entity}", set()).update(range(max(0, start - 120), min(len(text), end + 120)))
        expected = {}
        for entity, places in near.items():
            words = [m[0].lower() for m in re.finditer(r"(?!(?<![^\W_])[^\W\d_]{1,2}(?![^\W_]))[^\W_]+", blank) if places.issuperset(range(*m.span()))]
            expected[entity] = (sum(blank[i] != "\0" for i in places), sorted(words))
        got = {}
        for context in row.contexts:
            n, words = got.get(context.entity, (0, []))
            got[context.entity] = (n + context.n_chars, sorted(words + context.terms))
        assert got == expected, text


def test_short_names_and_codes_in_two_texts(spark):
    rows = [(i, f"{chr(97 + i) * 9} Kim, 王 李明 B7 4711 to bob@evil.org") for i in range(2)]
    assert listed(spark, rows) == dict.fromkeys(("kim", "王", "李明", "b7", "4711"), "cue")
    rows = spark.createDataFrame([*rows, *filler(), (99, "KIM B7 B77 王")], "doc_id long, text string")
    assert {row.doc_id: row.text for row in sanitise.redact(rows).collect()}[99] == "[TERM] [TERM] B77 [TERM]"
