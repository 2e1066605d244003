"""Learner fixture with signal, derived by Spark from the ``embeddings`` table
(FIXTURES.md section 2): eight features, a label that depends on them and a
held-out fifth of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EMBED_DIM = 8
EMBED_FEATURES = tuple(f"e{i}" for i in range(EMBED_DIM))


def labelled_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, e0..e7 double, label double, is_test boolean)."""
    emb = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    cols = [F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(EMBED_FEATURES)]
    return emb.select(
        "vec_id",
        *cols,
        (F.col("embedding")[0] + F.col("embedding")[1] > 0).cast("double").alias("label"),
        (F.col("vec_id") % 5 == 0).alias("is_test"),
    )
