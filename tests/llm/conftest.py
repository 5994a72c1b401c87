"""Fixtures of the training-data tests: a small table with the awkward rows."""

import pytest

from kerbside.llm.common import configure

PROSE = (
    "the committee met on a cold morning and agreed that the bridge across the river would be "
    "closed for repairs until the first week of spring when the water is low enough to inspect "
    "its piers and the masons can set new stones below the arch without a dam or pumps at all"
)


@pytest.fixture(autouse=True)
def configured(spark):
    configure(spark)


@pytest.fixture
def prose():
    return PROSE


@pytest.fixture
def documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing names."""
    giant = " ".join(f"{w}{i % 97}" for i in range(400) for w in PROSE.split()[:25])
    rows = [
        (1, PROSE, "en", "a", len(PROSE)),
        (2, PROSE, "en", "a", len(PROSE)),
        (3, PROSE + " indeed", None, None, None),
        (4, None, "en", "b", 0),
        (5, "", "fr", "b", 0),
        (6, "   \n\t ", "fr", "", 6),
        (7, giant, "en", "a", len(giant)),
        (8, "short text", "de", "c", 10),
        (8, "short text", "de", "c", 10),
        (None, "no id here but some words", "de", None, 25),
        (9, "日本語 のテキスト ﬁ é ▁ 🙂", "ja", "b", 20),
        (10, "line one of the text\nline one of the text\n\nother ### $$$ !!", "en", "c", 50),
    ]
    wide = [r + (5, "x", 0.5, 1, "k", "z") for r in rows]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    clash = "size long, key string, score double, place int, words string, fp string"
    return spark.createDataFrame(wide, f"{names}, {clash}")


@pytest.fixture
def nothing(documents):
    return documents.limit(0)
