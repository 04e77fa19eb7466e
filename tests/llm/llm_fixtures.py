import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SENTENCE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak near the river bank"


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


def rows():
    """Nulls, empty and long texts, ties, repeats, other scripts, near copies."""
    words = [f"w{i}" for i in range(400)]
    near = " ".join(words)
    out = [
        (0, None, "en", "b", 0), (1, "", "en", "b", 0), (2, " \n\t ", None, None, 4), (3, "one two", "en", "a", 7),
        (4, "one two", "en", "a", 7), (5, "One TWO", "en", "c", 7), (6, near, "en", "a", 1), (7, near, "en", "a", 1),
        (8, near.replace("w10 ", "x "), "en", "b", 1), (9, near.replace("w200 ", "y ").replace("w90 ", ""), "en", None, 1),
        (10, " ".join(words[:300] + [f"z{i}" for i in range(100)]), "en", "c", 1), (11, SENTENCE + "\n" + SENTENCE, "en", "c", 1),
        (12, "Straße ñandú 漢字 🙂 don't  \u00a0 stop\n\n\nend  ", "de", "é", 1), (13, "ab " * 60000, "en", "b", 180000),
        (14, "# $ % & | < > *\n# $ % & | < > *", "en", "a", 1), (None, "no id", None, "a", None), (15, SENTENCE.upper(), "en", "a", 1),
        (16, SENTENCE, "en", "a", 1), (16, SENTENCE, "en", "a", 1),
    ]
    return out + [(100 + i, f"{SENTENCE} {i} {i * i} " * 4, "en", "abc"[i % 3], 1) for i in range(40)]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def clashing(odd):
    """Columns with the names that operators use for themselves."""
    from pyspark.sql import functions as F

    names = ["digest", "size", "key", "place", "id_", "key_", "times", "rank", "range", "token", "kept", "host", "_t", "draw", "n_shingles"]
    return odd.select("*", *[F.lit(1).alias(n) for n in names])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, int(i != 14), 0) for i in [14, 6, 11, *range(100, 140)]], "doc_id bigint, quality int, toxic int")
