"""Small hostile tables shared by the operator tests."""

import pytest
from pyspark.sql import Row
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .texts import prose

SCHEMA = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
        # Names the operators use inside.
        StructField("row", StringType()),
        StructField("score", StringType()),
        StructField("size", StringType()),
        StructField("item", StringType()),
    ]
)


@pytest.fixture(scope="session")
def hostile(spark, tmp_path_factory):
    """Null, blank, tiny, repeated and very long texts, null ids and sources, clashing columns."""
    long_text = prose(99, 30_000)
    texts = [
        (1, prose(1, 60), "en", "a"),
        (2, prose(1, 60), "en", "a"),
        (2, prose(1, 60), "en", "a"),
        (3, None, "en", "b"),
        (4, "", "fr", None),
        (5, " \n\t ", None, "b"),
        (6, "x", "fr", "c"),
        (None, prose(2, 40), "fr", "c"),
        (None, None, None, None),
        (7, long_text, "en", "a"),
        (8, long_text + " coda", "en", "a"),
        (9, "\U0001f600 é ß Ω 12 !?", "fr", "\U0001f600"),
        (10, "same line of some length here\nsame line of some length here\nother", "en", "b"),
        (11, "same line of some length hare\n\n\nand one more line that stands alone", "en", "b"),
    ]
    rows = [
        (i, t, lang, source, len(t) if t is not None else None, "r", "s", "z", "i")
        for i, t, lang, source in texts
    ]
    path = str(tmp_path_factory.mktemp("hostile") / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def benchmark_table(spark):
    words = prose(1, 60).split()
    return spark.createDataFrame(
        [
            Row(item_id=1, text=" ".join(words[10:30]).upper()),
            Row(item_id=1, text=" ".join(words[10:30])),
            Row(item_id=20, text="nowhere to be found in any of the texts at all really"),
            Row(item_id=3, text="X"),
            Row(item_id=4, text=None),
            Row(item_id=5, text="?!"),
            Row(item_id=None, text=" ".join(prose(2, 40).split()[:12])),
        ],
        "item_id long, text string",
    )


@pytest.fixture(scope="session")
def label_table(spark):
    return spark.createDataFrame(
        [(1, 1, 0), (2, 0, 1), (2, 1, 0), (3, 1, 1), (6, None, None), (7, 0, 0), (None, 1, 1), (777, 0, 1), (8, 5, 9)],
        StructType(
            [
                StructField("doc_id", LongType()),
                StructField("quality", IntegerType()),
                StructField("toxic", IntegerType()),
            ]
        ),
    )
