import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty, blank and long texts, repeated rows, columns whose names clash with added ones."""
    long = "wort " * 30_000
    rows = [(1, "Hello  big\tworld", "a", 1), (2, "Hello big world", "a", 2), (3, None, None, 3), (4, "", "b", None), (4, "", "b", None),
            (None, "no id here", "b", 5), (6, long, "a", 6), (7, "é ßü\n日本 x", None, 7), (8, " \n ", "a", 8), (2, "other text, same id", "a", 9)]
    return spark.createDataFrame([(i, t, s, "en", n, n, "x", n) for i, t, s, n in rows],
                                 "doc_id long, text string, source string, lang string, n_chars int, size int, shard string, block int")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("doc_id < 0")
