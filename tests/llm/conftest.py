import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = "the quick brown fox jumps over the lazy dog and runs away from it all before the evening comes"


def odd_rows():
    """Nulls in every column, blank and long texts, copies, ties and repeated rows."""
    words = " ".join(f"w{i}" for i in range(60))
    return [
        (1, words, "en", "a", None), (2, words, "en", "a", 3), (3, words + " x", "en", "b", 3),
        (4, None, "en", "a", 3), (5, "", None, "b", 0), (6, " \n\t ", "en", None, 3),
        (None, words, "en", "b", 3), (None, None, None, None, None), (7, "one two", "en", None, 7),
        (8, f"before it {PASSAGE} after", "en", "c", 1), (9, f"elsewhere {PASSAGE} again and on", "en", "c", 1),
        (10, "é" * 70 + " ß ü \U0001f600", "de", "c", 1), (11, "é" * 70, "de", "é", 1),
        (12, "a " * 30_000, "en", "a", 60_000), (12, "a " * 30_000, "en", "a", 60_000), (13, "a" * 5_000, "en", "d", 1),
        (14, " ".join(f"v{i % 977}x{i // 977}" for i in range(30_000)), "en", "a", 1),
    ]


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture
def clashing(odd):
    """The odd rows with columns named like those the operators make, or like their own in other case."""
    from pyspark.sql import functions as F

    names = ("rest chunk packed kept size part key start offset range rank place shard slot source_no target taken bucket"
             " print root host kept_ n_words base_failed piece bin group score epoch left tie n c0 c1").split()
    more = odd.select("*", *[F.lit("clash").alias(n) for n in names])
    return more.toDF(*more.columns)


def bag(df, *names):
    from collections import Counter

    return Counter(tuple(r[n] for n in names) for r in df.collect())
