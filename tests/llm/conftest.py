import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Further columns that have the names of the operators' working columns.
CLASHING = "key long, `row` string, node long, draw double, score double, label string, `a.b` int, host string"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    chance = random.Random(seed)
    return " ".join(f"w{chance.randrange(vocabulary)}" for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, white space of all kinds."""
    copy = prose(1, 80)
    near = copy.split()
    near[40] = "changed"
    rows = [
        (1, copy, "en", "a", 5),
        (2, copy, "en", "b", 5),
        (3, " ".join(near), "en", "a", 5),
        (4, "", "en", "a", 0),
        (5, None, "en", None, None),
        (None, "null key one", None, "a", 3),
        (None, "null key two", None, "a", 3),
        (6, "  \t\n ", None, "c", 4),
        (7, "tie", "en", "c", 3),
        (7, "tie", "en", "c", 3),
        (8, "Ünïcode <|endoftext|> wörds and 漢字 don't\x1c stop.\r\nnext  line", "de", "c", 9),
        (9, prose(2, 20_000), "en", "b", None),
        (10, "x" * 30_000, "en", "b", None),
        (11, "one two three", "en", "d", 3),
        (12, "one two three", "en", "d", 3),
        (13, "repeat this line\n" * 30, "en", "d", 3),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    rows = [(*r, i, "r", i, 0.5, 0.5, "l", 1, "h") for i, r in enumerate(odd_rows)]
    return spark.createDataFrame(rows, f"{SCHEMA}, {CLASHING}").repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(30)] + [(None, 1, 1), (3, None, None), (2, 0, 0), (2, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
