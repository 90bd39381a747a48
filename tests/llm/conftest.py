import random

import pytest

VOCABULARY = [a + b + c for a in ("ka", "lo", "mi", "ru", "se", "ta", "vo", "ze") for b in ("n", "r", "s", "t") for c in ("a", "e", "o", "um", "ix", "el")]


@pytest.fixture(scope="session")
def prose():
    """Texts of random words by seed."""
    def make(seed, n):
        rng = random.Random(seed)
        return " ".join(rng.choice(VOCABULARY) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def odd_docs(spark, prose):
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns whose names operators use."""
    long = prose(1, 40_000)
    rows = [(1, prose(2, 80), "en", "a", 1, 0.5), (1, prose(2, 80), "en", "a", 1, 0.5), (2, None, None, None, None, None), (3, "", "en", "b", 0, 0.1),
            (None, prose(3, 60), "en", "b", 1, None), (None, None, None, None, None, None), (4, long, "fr", "a", 1, 1.0), (5, " \n\t ", "en", "", 1, 1.0),
            (6, "one", "en", "b", 1, 1.0), (7, prose(2, 80), "en", "a", 1, 0.5)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double").selectExpr(
        "*", "1 as judged", "2 as found", "3 as made", "4 as rank", "5 as copies", "6 as fp", "7 as component_id", "8 as whole", "9 as n", "10 as size", "11 as turn", "12 as hits")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
