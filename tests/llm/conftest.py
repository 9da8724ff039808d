from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash string, size int"


@pytest.fixture(scope="session")
def edge(spark):
    """Documents with nulls in every column, empty and very long texts, ties, repeated rows and clashing columns."""
    long_ = " ".join(f"word{i % 977} the of" for i in range(12_000))
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon"
    rows = [
        (1, base, "en", "a", 1, "h", 1), (2, base.upper(), "en", "a", 1, "h", 1), (3, base.replace("tau", "TAU2"), "en", "b", 1, "h", 1), (4, None, "en", "b", None, None, None), (5, "", "de", None, 0, "h", 1),
        (6, " \t\n ", None, "a", 0, "h", 1), (7, "two words", "de", "c", 1, "h", 1), (8, "Two  WORDS", "de", "c", 1, "h", 1), (9, long_, "fr", "a", 1, "h", 1), (10, long_, "fr", None, 1, "h", 1),
        (None, "a text without any id at all", None, None, None, None, None), (11, "der die das und ist nicht mit für", "de", "c", 1, "h", 1), (11, "der die das und ist nicht mit für", "de", "c", 1, "h", 1),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def documents(spark, texts, **columns):
    rows = [(i, t, columns.get("lang", {}).get(i), columns.get("source", {}).get(i)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
