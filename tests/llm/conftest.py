from __future__ import annotations

import pytest

#: Nulls, empty and blank texts, ties, repeated rows, a clashing column.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en"),
    (3, None, None),
    (4, "", "fr"),
    (5, " \t\n ", "xx"),
    (None, "no id here but text", "en"),
    (6, "The quick brown fox jumps over the lazy dog near the river bank today ", "en"),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en"),
    (7, "x" * 50_000, "en"),
    (8, "word " * 20_000, "de"),
    (9, "line a 12\nline b\nline a 13\n\nline b", "en"),
    (10, "line a 99\nother", "en"),
    (11, "line a 7\nline b", "en"),
    (None, "a second text without an id\nline b", "en"),
    (None, "a second text without an id\nline b", "en"),
    (None, None, None),
    (12, "one id\nline a 5", "en"),
    (12, "the same id and another text\nline b", "ru"),
    (13, " " * 30_000, "en"),
]


@pytest.fixture(scope="session")
def edge(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    return df.withColumns({"fp": F.lit("clash"), "h": F.lit(1), "kept": F.lit("old"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
