import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use inside
        T.StructField("row", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("label", T.StringType()),
        T.StructField("score", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents from (doc_id, text), with extra columns whose names clash."""

    def make(rows):
        return spark.createDataFrame([(i, t, None, "s", 0, "r", "k", "l", "x") for i, t in rows], SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(900)]
    return lambda n, seed=None: (random.Random(seed) if seed is not None else rng).choices(vocabulary, k=n)
