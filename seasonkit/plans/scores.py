"""Common score-table layout shared by every learner.

One row per (model, scored row): ``model``, ``model_ord``, the row keys,
``label`` (0/1 double), ``p1`` (positive-class probability), ``margin``
(ranking score: decision margin where the model has one, else ``p1``) and
``prediction`` (the model's own 0/1 decision).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def score_rows(
    df: DataFrame,
    model: str,
    model_ord: int,
    keys: Sequence[str],
    p1: Column,
    margin: Column | None = None,
    prediction: Column | None = None,
) -> DataFrame:
    return df.select(
        F.lit(model).alias("model"),
        F.lit(int(model_ord)).alias("model_ord"),
        *keys,
        F.col("label").cast("double").alias("label"),
        p1.cast("double").alias("p1"),
        (margin if margin is not None else p1).cast("double").alias("margin"),
        (prediction if prediction is not None else F.col("prediction")).cast("double").alias("prediction"),
    )
