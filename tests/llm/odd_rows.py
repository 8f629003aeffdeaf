"""Rows that every operator must take: nulls, empty and long texts, ties, clashing names."""

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # Names that clash with those used inside.
    T.StructField("score", T.StringType()), T.StructField("class", T.LongType()),
    T.StructField("hits", T.StringType()), T.StructField("epochs", T.IntegerType())])

PROSE = ("the ones that heard of it were from the thing and there was an end to the matter "
         "before anyone could say what had been said about the other thing in the house").split()


def prose(n, seed):
    return " ".join(PROSE[(i * i + seed * 7 + i * seed) % len(PROSE)] + str((i * seed) % 11)
                    for i in range(n))


ODD = [
    (0, None, None, None, None), (1, "", "en", "a", 0), (2, "   \n\t ", "en", "a", 5),
    (3, "one", "en", "a", 3), (4, "One two  three", None, "a", 14),
    (5, prose(90, 3), "en", "a", None), (6, prose(90, 3), "en", None, -1),
    (7, prose(90, 3).upper(), "en", "b", 600), (8, prose(60, 5) + " tail " + prose(50, 3), "en", "b", 1),
    (8, prose(60, 5) + " tail " + prose(50, 3), "en", "b", 1),
    (9, "word " * 4000, "en", "b", 20000), (10, prose(6000, 13), "en", "c", 40000),
    (11, "é è 中文 \U0001F600 ñ", "fr", "c", 9), (None, prose(80, 9), "de", "c", 8),
    (None, None, None, None, None), (12, "\x1f\x0b\x1cx \x85y", "en", "", 7),
    (13, "x" * 30000, "en", "c", 30000), (14, "7" * 20000 + "." * 50 + "@" * 500, "en", "c", 3),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(*r, "s", 1, None, 2) for r in ODD]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
