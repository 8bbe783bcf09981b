import random

import pytest

CLASH = "doc_id long, text string, row string, tag long, quality string, `a.b` int"


def prose(rng, n, words=("the", "and", "of", "river", "stone", "light", "walks", "under", "house", "green", "seven", "quiet")):
    return " ".join(rng.choice(words) + rng.choice(("", "", "s", "ly")) for _ in range(n))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, clashing column names."""
    rng = random.Random(11)
    base = prose(rng, 120)
    long = prose(rng, 30_000)
    rows = [
        (1, base, "r", 1, "q", 1), (1, base, "r", 1, "q", 1), (2, base, None, None, None, None), (3, None, "r", 2, "q", 3), (4, "", "r", 2, "q", 4),
        (5, " \n\t ", "r", 2, "q", 4), (None, base, "r", 2, "q", 4), (None, None, None, None, None, None), (6, long, "r", 5, "q", 5), (7, long + " tail", "r", 5, "q", 5),
        (8, "one", "r", 5, "q", 5), (9, "x" * 5_000, "r", 5, "q", 5), (10, "Ünï cødé 日本 😀 " * 30, "r", 5, "q", 5), (11, "12 34 !!", "r", 5, "q", 5),
    ]
    return spark.createDataFrame(rows, CLASH).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], CLASH)
