import random

import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def words():
    """A text of so many made-up words."""

    def text(seed, n, pool=400):
        rng = random.Random(seed)
        stems = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(pool)]
        return " ".join(rng.choice(stems) for _ in range(n))

    return text


DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        # names that the operators use themselves
        T.StructField("node", T.StringType()),
        T.StructField("rate", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("repeated", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def awkward(spark, words):
    """Null and empty texts, null and repeated ids, copies, odd characters, a long text, extra columns."""
    long = words(1, 6_000)
    near = long.split(" ")
    near[3_017] = "changed"
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (None, "no id here"),
        (4, long),
        (5, " ".join(near)),
        (6, long.upper()),
        (6, long.upper()),
        (7, "short one"),
        (8, "SHORT  one"),
        (9, "ünïcode 😀 \x00 text with ñ and ß"),
        (10, "ünïcode 😀 \x00 text with ñ and ß"),
        (11, words(2, 50)),
        (None, None),
    ]
    return spark.createDataFrame([(*r, "en", "x", "x", "x", "x") for r in rows], DOCUMENTS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
