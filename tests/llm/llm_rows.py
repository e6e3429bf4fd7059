"""Fixtures the tests of this folder import."""

import pytest

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, label STRING, node STRING, lines STRING, toxicity STRING"


@pytest.fixture
def docs(spark):
    """Rows of (id, text) as documents, with further columns named as the operators' own."""

    def make(rows):
        full = [(i, t, "en", "s", len(t or ""), "x", "y", "z", "w") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
ODD = [(None, "a null id"), (1, None), (2, ""), (3, " \n\t \n"), (4, LONG), (5, "twice over"), (5, "twice over"), (6, "one\ttab 梦 ▁ 😀 ﬁ")]


@pytest.fixture
def odd(docs):
    """Nulls, empty and very long texts, repeated rows, clashing names."""
    return docs(ODD)


@pytest.fixture
def empty(docs):
    return docs([])
