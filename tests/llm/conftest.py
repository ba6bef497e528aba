from __future__ import annotations

import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents():
    """Rows of the smallest documents table as tuples."""
    return duckdb.sql(f"SELECT doc_id, text, lang, source, n_chars FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def edge_rows(documents):
    """Nulls in every column, empty and blank texts, copies, repeated rows, a long text and a long run of digits."""
    text = documents[0][1]
    return [
        (None, None, None, None, None), (1, None, "en", "a", 0), (2, "", "en", None, 0), (3, " \n\t ", None, "a", 4), (4, text, "en", "a", 9),
        (4, text, "en", "a", 9), (5, text, "de", "b", 9), (None, text, "en", "a", 9), (6, "word", "xx", "a", 4), (-7, text[: len(text) // 2], "fr", "b", 1),
        (8, f"{text} " * 60, "en", "a", 1), (9, "1 2-3" * 20_000 + "a" * 50_000, "en", "b", 1), (10, "É́ ΣΑΣ  x　y ퟿ 你好 😀", "es", "b", 1),
        (11, "12345 !!! ???", "en", "a", 1), (12, "one <|endoftext|> two<|startoftext|>three <|ENDOFTEXT|> four", "en", "a", 1),
        (13, "<|endoftext|>", "de", "b", 1), (14, f"{text} <|endoftext|>{text}", "en", "a", 1),
    ]


@pytest.fixture
def edge_docs(spark, edge_rows):
    """The edge rows with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(edge_rows, SCHEMA)
    clashes = ("rank", "row", "kept", "stats", "vector", "fingerprint", "root", "spans", "base", "slot", "place", "length", "piece", "v", "_rank", "extra", "key", "score")
    return docs.select("*", *[F.lit("x").alias(c) for c in clashes])


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def same_rows(a, b):
    assert sorted(map(repr, a)) == sorted(map(repr, b))
