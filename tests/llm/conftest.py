"""A table of awkward documents that every operator must take."""

import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty, blank and long texts, ties, repeated rows, near copies, clashing extra columns."""
    shared = prose(1, 120)
    rows = [
        (1, prose(2, 200) + " " + shared, "a"), (2, shared + " " + prose(3, 150), "b"), (3, None, "a"), (4, "", None),
        (5, " \t\n", "b"), (6, "one", "c"), (7, "one two three", "c"), (8, prose(4, 20_000), "a"), (9, "x" * 3_000, "c"),
        (10, "a " * 400, "a"), (11, prose(5, 300), "b"), (12, prose(5, 300) + " tail", "b"), (12, prose(5, 300) + " tail", "b"),
        (None, prose(6, 90), "a"), (None, prose(5, 300), None), (13, "É ß é \U0001f600 " * 60, "d"), (14, prose(7, 100), ""),
        (15, "password=abcdef1234 and AKIA" + "Z9" * 9 + " " + "0123456789abcdef" * 2, "a"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.selectExpr("*", "'en' AS lang", "length(text) AS n_chars", "1 AS size", "'k' AS k1", "2 AS row", "0.5D AS score")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")


def by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: [(x is None, x) for x in r])
