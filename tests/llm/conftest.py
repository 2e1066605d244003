import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, _spans string, shard string, rep string, _key string, _features string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and long texts, repeated rows, clashing extra columns."""
    long_text = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
    copy = "one two three four five six seven eight nine ten eleven twelve " * 4
    texts = [
        (1, copy), (2, copy), (2, copy), (3, None), (4, ""), (5, ""), (6, long_text), (7, long_text),
        (8, "!!! ..."), (9, "lone"), (None, "a text without an id, token=abcdefgh12 a@b.example 10.0.0.1"),
        (10, copy.upper()), (11, "naïve Füße 東京 \U0001f600 password: 'hunter2x' \U0001f600 +1 (212) 555-0100"),
    ]
    rows = [(i, t, None if i == 1 else "en", None, len(t) if t else None, "x", "y", "z", "k", "f") for i, t in texts]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def odd_labels(spark):
    rows = [(i, i % 2, int(i % 5 == 0)) for i in range(1, 12)] + [(None, 1, 1), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
