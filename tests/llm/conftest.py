import pytest
from corpus_cases import ODD
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that the operators use themselves
        T.StructField("id", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (id, text) pairs, in several partitions, with clashing extra columns."""

    def make(pairs, partitions=3):
        rows = [(i, t, "en" if n % 3 else None, None, None, "x", None, 7, 0.5) for n, (i, t) in enumerate(pairs)]
        return spark.createDataFrame(rows, DOCUMENT).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def odd(documents):
    return documents(ODD)


@pytest.fixture(scope="session")
def empty(documents):
    return documents([])
