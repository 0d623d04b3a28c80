from __future__ import annotations

import pytest

SF_DIR = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(20_000)) + "."
BASE = " ".join(f"alpha{i} beta{i % 7}" for i in range(60))


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing columns."""
    rows = [
        (1, BASE, "en", "a", 1),
        (2, BASE, "en", "a", 1),
        (3, BASE.replace("alpha5 ", "gamma "), "en", "b", 1),
        (4, None, "en", "b", 1),
        (5, "", "fr", None, 1),
        (6, LONG, None, "b", 1),
        (7, " \t\n ", "de", "c", None),
        (8, "two words", "fr", "c", 1),
        (8, "two words", "fr", "c", 1),
        (None, "Étude ñandú straße 中文 \U0001f600 ok.", "es", "", 1),
        (None, None, None, None, None),
        (9, "123 456 !!", "en", "a", 1),
        (10, "nul\0 and \1 \2 marks\x1c", "en", "a", 1),
    ]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    return frame.selectExpr(
        "*", "'x' as score", "'x' as lang_pred", "'x' as size", "7 as shard", "'n' as node", "'c' as copies"
    )


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
