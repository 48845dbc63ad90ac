import random

import pytest
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("pos", "x", "gid", "doc", "begin", "key", "rep", "id", "component", "n_words", "score", "positive")


def made(spark, rows):
    """Documents from (doc_id, text, lang), with extra columns named like the operators' own."""
    full = [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows]
    df = spark.createDataFrame(full, COLUMNS)
    return df.withColumns({c: F.lit(1) for c in CLASHING})


def prose(rng, n, words):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, very long, tied, repeated and near-equal texts; a null id."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    base = prose(rng, 200, words).split()
    passage = prose(rng, 80, words)
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three"), (6, "One two three")]
    rows += [(10 + i, prose(rng, 60 + i, words) + " " + passage + "\n" + prose(rng, 30, words)) for i in range(6)]
    for i in range(8):
        copy = list(base)
        for k in range(i):
            copy[rng.randrange(len(copy))] = "edit%d" % k
        rows.append((30 + i, " ".join(copy)))
    rows += [(50, " ".join(base)), (51, " ".join(base)), (60, "again " * 300 + "x y z"), (61, "again " * 250 + "q")]
    rows += [(62, "é漢\U0001F600 don't  stop\r\n'll 123 " * 40), (63, "a" * 5000), (64, prose(rng, 8000, words))]
    rows += [(70, prose(rng, 55, words))] * 2
    rows += [(None, passage)]
    return [(i, t, "en") for i, t in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return made(spark, odd_rows).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return made(spark, [])
