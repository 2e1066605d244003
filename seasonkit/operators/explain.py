"""Feature rankings and decision grids.

* ``top_importances`` -- order (feature, importance) by importance, then name,
  both descending, keep ``k`` (a top-k report: the limit is the feature).
* ``label_correlations`` -- |corr(feature, label)| for every feature in one
  aggregate, unpivoted: an importance that SQL can check.
* ``coefficient_importances`` -- |weight| of a fitted linear model.
* ``decision_grid`` -- score a mesh over two columns with a fitted model. The
  bounds are one aggregate row; the mesh itself is generated on the executors
  by ``spark.range`` over the cell count (cell i → (i // ny, i % ny)), so it
  needs no join and no driver-side list, at any size.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import GRID_STEP, TOP_IMPORTANCES


def top_importances(imp: DataFrame, k: int | None = TOP_IMPORTANCES, group: Sequence[str] = ()) -> DataFrame:
    """Top ``k`` rows by (importance desc, feature desc); ``k=None`` keeps all."""
    if not group:
        out = imp.orderBy(F.desc("importance"), F.desc("feature"))
        return out if k is None else out.limit(k)
    from pyspark.sql import Window

    w = Window.partitionBy(*group).orderBy(F.desc("importance"), F.desc("feature"))
    ranked = imp.withColumn("rank", F.row_number().over(w))
    return ranked if k is None else ranked.filter(F.col("rank") <= k)


def _unpivot(wide: DataFrame, names: Sequence[str], value: str) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias(value)) for n in names])
    return wide.select(F.inline(rows))


def label_correlations(df: DataFrame, features: Sequence[str], label: str = "label") -> DataFrame:
    """(feature, importance = |Pearson r with the label|), one pass."""
    wide = df.agg(*[F.abs(F.corr(F.col(c), F.col(label).cast("double"))).alias(c) for c in features])
    return _unpivot(wide, features, "importance")


def coefficient_importances(spark: SparkSession, coefficients, features: Sequence[str]) -> DataFrame:
    """(feature, importance = |weight|) from a linear model's coefficient vector."""
    rows = [(f, abs(float(c))) for f, c in zip(features, coefficients)]
    return spark.createDataFrame(rows, "feature string, importance double")


def grid_bounds(train: DataFrame, x: str, y: str) -> tuple[float, float, float, float]:
    r = train.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    return float(r[0]), float(r[1]), float(r[2]), float(r[3])


def mesh(spark: SparkSession, x0: float, x1: float, y0: float, y1: float, step: float = GRID_STEP, x="x", y="y"):
    """Points ``x0 + i*step`` (< x1) × ``y0 + j*step`` (< y1), numpy ``arange`` style."""
    nx = max(0, math.ceil((x1 - x0) / step))
    ny = max(0, math.ceil((y1 - y0) / step))
    cells = spark.range(0, nx * ny)
    i = F.floor(F.col("id") / F.lit(ny)) if ny else F.lit(0)
    j = F.pmod(F.col("id"), F.lit(ny)) if ny else F.lit(0)
    return cells.select(
        (F.lit(x0) + i.cast("double") * F.lit(step)).alias(x),
        (F.lit(y0) + j.cast("double") * F.lit(step)).alias(y),
    )


def decision_grid(
    train: DataFrame,
    x: str,
    y: str,
    predict: Callable[[DataFrame], DataFrame],
    step: float = GRID_STEP,
) -> DataFrame:
    """(x, y, predicted) over the mesh spanning the training rows.

    ``predict`` maps a DataFrame with columns ``x``/``y`` (named as in the
    training table) to one with a ``prediction`` column.
    """
    x0, x1, y0, y1 = grid_bounds(train, x, y)
    pts = mesh(train.sparkSession, x0, x1, y0, y1, step, x, y)
    return predict(pts).select(x, y, F.col("prediction").cast("double").alias("predicted"))
