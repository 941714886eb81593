from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents():
    """The rows (doc_id, text) of the smallest documents table."""
    return duckdb.sql(f"select doc_id, coalesce(text, '') from '{SF}/documents.parquet'").fetchall()


@pytest.fixture
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names operators might use."""
    long = "lorem ipsum dolor sit amet " * 20_000
    rows = [
        (1, "The quick brown fox jumps.", "a"), (2, None, "b"), (3, "", "c"), (4, long, "d"), (5, "x" * 200_000, "e"),
        (None, "no id here at all", "f"), (7, "The quick brown fox jumps.", "g"), (7, "The quick brown fox jumps.", "g"),
        (8, "...!!!", None), (9, "Ünïcode ﬁ 漢字 <|endoftext|> \U0001f600\r\n\t", "h"), (10, "", "i"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    return df.selectExpr("*", "1 as score", "'k' as key", "2 as _stats", "3 as n", "4 as file", "'y' as `row`", "5 as `a.b`", "6 as `_metadata`")


@pytest.fixture
def empty(odd):
    return odd.limit(0)
