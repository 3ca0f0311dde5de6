import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

# Every kind of row the operators have to take: nulls, empty and blank texts, ties, repeated rows.
LONG = " ".join(f"w{k % 997}" for k in range(30_000))
ODD_ROWS = [
    (1, "", "en"), (2, None, "en"), (3, " \t\n ", None), (4, "one", "en"), (5, "!!! ... 12345", None),
    (6, LONG, "en"), (7, LONG, "en"), (8, "same row", "en"), (8, "same row", "en"), (9, "ein zwei\x00drei 🙂 日本", "de"),
    (None, "a row without an id", "en"),
]


@pytest.fixture(scope="session")
def frame(spark):
    """Function: rows of (doc_id, text, lang) to a documents table with clashing extra columns."""

    def build(rows):
        made = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        return made.selectExpr(
            "doc_id", "text", "lang", "'s' AS source", "bigint(length(text)) AS n_chars",
            "1 AS score", "2 AS rep", "3 AS key", "4 AS kept", "5 AS a", "6 AS start", "7 AS s", "8 AS base",
        )

    return build


@pytest.fixture(scope="session")
def odd(frame):
    return frame(ODD_ROWS)


@pytest.fixture(scope="session")
def empty(frame):
    return frame([])


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def by_id(df):
    return {row.doc_id: row for row in df.collect()}
