import pytest

from tidemark.llm.store import share_code


@pytest.fixture(autouse=True)
def code_on_workers(spark):
    share_code(spark)


@pytest.fixture
def odd_documents(spark):
    """Nulls in every column, empty and long texts, repeated rows, one id with two texts, and columns with clashing names."""
    rows = [
        (None, None, None, None),
        (None, "", "en", "s"),
        (None, "some words of a text without id", None, None),
        (1, None, "en", "s"),
        (1, "", "en", "s"),
        (2, "one", "en", "s"),
        (3, "one", "en", None),
        (3, "one", "en", None),
        (4, " \t\n", None, "s"),
        (5, "many words " * 20_000, "en", "s"),
        (6, "x" * 100_000, "en", "s"),
        (7, "many words " * 20_000, "en", "s"),
        (8, "12 34 !!", "en", "s"),
    ]
    return spark.createDataFrame(
        [(i, t, lang, s, 0, "c", 1, 2, 3) for i, t, lang, s in rows],
        "doc_id long, text string, lang string, source string, n_chars long, digest string, kind int, component long, n long",
    )
