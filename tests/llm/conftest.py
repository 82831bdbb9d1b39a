import pytest
from pyspark.sql import DataFrame
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside must not get in their way
        T.StructField("n", T.IntegerType()),
        T.StructField("component", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("class", T.StringType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark):
    """Builds documents of (id, text) or (id, text, lang), with extra columns of clashing names."""

    def build(rows, partitions: int = 3) -> DataFrame:
        full = [(i, t, (more or ["en"])[0], None, None if t is None else len(t), 7, "x", "y", None) for i, t, *more in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)

    return build


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, very long, one endless word, repeated rows, a null id, and characters of four bytes."""
    return [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b "),
        (4, "word " * 30_000),
        (5, "x" * 60_000),
        (6, "twice the same row of words here"),
        (6, "twice the same row of words here"),
        (None, "no id but some words in a row"),
        (7, "a🎉b 日本語   ñandú — “quoted” é"),
        (8, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16"),
    ]
