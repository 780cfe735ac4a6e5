import random

import pytest

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, doc string, row long, score string, size string, kept string"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    parts = "an be co de er fi go ha in ka lo me no or pe ra se ti un va".split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls everywhere, empty and long texts, repeated ids and rows; the extra columns clash with inner names."""
    long = prose(1, 30_000)
    rows = [
        (1, prose(2, 80)), (2, None), (None, prose(3, 60)), (None, None), (3, ""), (3, prose(4, 50)),
        (4, prose(5, 70)), (4, prose(5, 70)), (5, long), (6, long), (7, " \n\t "), (8, "!!! ???"), (9, "one two"), (10, "ünï 日本 \U0001F600 x" * 30),
    ]
    sources = ["b", None, "a", "", "b"]
    return [(i, t, None, sources[n % 5], None, "d", n, "s", None, "k") for n, (i, t) in enumerate(rows)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, COLUMNS).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
