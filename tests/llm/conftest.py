"""Small tables with the awkward rows that every operator must take."""

import random

import pytest

LONG = " ".join(f"w{i % 977}" for i in range(30_000))


@pytest.fixture(scope="session")
def awkward(spark):
    """doc_id, text with nulls, empty and long texts, repeats and ties; and columns of other names' kinds."""
    words = "alpha beta gamma delta the of and Ça Ünter naïve 東京 x1 don't !? tail".split()
    pick = random.Random(7)
    rows = [(i, " ".join(pick.choices(words, k=pick.randint(1, 60)))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, " \t\n"), (103, LONG), (104, "one"), (105, "one two"), (106, "A\nB\nA\nB\n")]
    rows += [(200 + i, rows[3][1]) for i in range(12)] + [(3, rows[3][1]), (3, rows[3][1]), (None, "one two"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr("doc_id", "text", "'x' AS key", "1 AS fp", "2L AS block", "'y' AS body", "0 AS size", "'z' AS host")


@pytest.fixture(scope="session")
def none(awkward):
    return awkward.limit(0)
