import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_data import frame, words  # noqa: E402


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty, blank, long and repeated texts, repeated rows, a repeated id."""
    base = " ".join(words(1, 80))
    return [(1, base, "en", "a"), (2, base, "en", "b"), (3, None, "en", "a"), (4, "", None, "b"), (5, " \n\t ", "de", None),
            (6, "One two", "en", "a"), (7, "x" * 30_000, "en", "a"), (8, " ".join(words(2, 9000)), "de", "c"),
            (None, base, "en", "a"), (None, None, None, None), (9, "1234 5678 !!", "en", "a"), (10, "日本語 の 文章 です", "ja", "d"),
            (11, base, "en", "a"), (11, base, "en", "a"), (12, "one TWO", "en", "b"), (12, "another text for the same id", "en", "b"),
            (13, "Is on he. " * 300, "en", "a"), (14, "a\x00b   c\r\nd", "fr", "e")]


@pytest.fixture(scope="session")
def edges(spark, edge_rows):
    return frame(spark, edge_rows).repartition(3, F.col("text"))


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
