"""Small frames with the cases that every operator must survive."""

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"

AWKWARD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, "a", 3),
    (4, "one", "en", None, 3),
    (5, "Equal text on two rows of one id, long enough to have some windows of words in it.", "en", "a", 82),
    (5, "Equal text on two rows of one id, long enough to have some windows of words in it.", "en", "a", 82),
    (None, "A row without an id that says something short.", "en", "b", 46),
    (6, "Ünïcödé ßtraße 漢字 привет 🙂🙂 ok", "de", "b", 30),
    (7, "word " * 30_000, "en", "b", 150_000),
    (8, "x" * 100_000, "fr", "c", 100_000),
    (9, "###$$$%%% &&& *** |||", "es", "c", 21),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and very long texts, equal rows, and columns named like results."""
    rows = spark.createDataFrame(AWKWARD, SCHEMA)
    clashing = ("n_words", "kept", "key", "bands", "node", "size", "ids", "id", "label", "found",
                "pii_found", "word_key", "contaminated", "lang_pred", "path", "value", "split")
    return rows.selectExpr("*", *(f"'clash' AS {c}" for c in clashing))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents():
    return duckdb.sql(f"SELECT * FROM '{SMALL}/documents.parquet' ORDER BY doc_id").fetchall()
