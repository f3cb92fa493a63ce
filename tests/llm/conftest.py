from __future__ import annotations

import pytest

from tests.conftest import SMALL

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

#: Nulls, empty and short texts, ties, repeated rows, odd characters, a long text.
ODD_ROWS = [
    (1, "One two three four five six seven eight nine ten eleven twelve.", "en", "b", None),
    (1, "One two three four five six seven eight nine ten eleven twelve.", "en", "b", None),
    (2, None, "en", None, 0),
    (3, "", None, "a", 0),
    (4, "один два три, é à ß\tü\n\u2028 \U0001f600 \x00 \x01", "ru", "", 5),
    (5, "x", "en", "a", 1),
    (None, "a text whose id is missing", None, "a", 1),
    (6, "... 123 !!", "en", "a", 9),
    (7, "long word " * 30_000 + "end", "en", "b", None),
    (8, "ONE TWO three FOUR five six seven eight nine ten eleven twelve.", "en", "c", None),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with more columns, whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(ODD_ROWS, DOCS)
    clashing = ("size", "key", "row", "kind", "anchor", "start", "fingerprint", "block", "score", "words", "host", "items")
    return rows.select("*", *(F.lit("x").alias(c) for c in clashing))


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}
