from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
TRICKY = [
    (0, None, None, None, None),
    (1, "", "en", "a", 0),
    (2, "   \t\n ", "en", "a", 6),
    (3, "One two THREE four five six seven eight nine ten eleven.", "en", "a", 9),
    (4, "one two three four five six seven eight nine ten eleven.", "en", None, 9),
    (5, "one two three four five six seven eight nine ten eleven.", "en", None, 9),
    (5, "one two three four five six seven eight nine ten eleven.", "en", None, 9),
    (7, "a" * 1500, "en", "b", 1500),
    (8, "ab" * 600 + "x", "en", "b", 1201),
    (9, "Übergrößé ñandú 漢字 \U0001f600 " * 40, "de", "b", 1),
    (10, " ".join(f"w{i % 97}" for i in range(30_000)), "en", "c", 1),
    (12, "x", "en", "c", 1),
    (13, "don't <|endoftext|> I'LL \x1c it is odd\x85ly Σας ΣΑΣ", "en", "c", 1),
]


@pytest.fixture
def tricky(spark):
    """Documents with every awkward case, spread over several partitions."""
    return spark.createDataFrame(TRICKY, DOCS).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def clashing(tricky):
    """Further columns with names that the operators use inside."""
    from pyspark.sql import functions as F

    names = ("id", "size", "fp", "key", "mark", "digest", "shard", "cell", "score", "draw", "copies", "part", "n", "row")
    return tricky.select("*", *[F.lit("x").alias(c) for c in names])
