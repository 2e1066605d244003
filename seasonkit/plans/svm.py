"""Calibrated support vector machines, linear or on kernel features.

The k models of the calibration folds and the final model are fitted together (``newton``): one aggregate a step for all of
them. Each row's out-of-fold margin then comes from the model that has not seen it, and a sigmoid is fitted to these margins
with Platt's smoothed targets, again by Newton steps. The duality gap of every model is returned with the fit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .newton import LinearFit, fit_linear
from .platt import fold_of, platt_targets
from .sums import matrix

#: Ridge of the calibration, for margins that are all alike.
RIDGE = 1e-9


@dataclass
class Svm:
    """The final model, the fold models, and the calibration ``p = 1 / (1 + exp(-(a * margin + b)))``."""

    final: LinearFit
    folds: list[LinearFit]
    a: float
    b: float
    kernel: Callable[[np.ndarray], np.ndarray] | None

    @property
    def gap(self) -> float:
        """The largest relative duality gap of all the models."""
        return max(f.residual for f in (self.final, *self.folds))

    def margin(self, spark, features: Sequence[str]) -> Column:
        if self.kernel is None:
            return self.final.margin(features)
        dim = len(features)
        sent = spark.sparkContext.broadcast((self.kernel, self.final.weights, self.final.intercept))

        def margins(x: pa.Array) -> pa.Array:
            kernel, w, b = sent.value
            return pa.array(kernel(matrix(x, dim)) @ w + b)

        return F.arrow_udf(margins, "double")(F.array(*[F.col(c).cast("double") for c in features]))


def design(train: DataFrame, features: Sequence[str], keys: Sequence[str], folds: int) -> DataFrame:
    """(x, t, fold), written: what every step reads."""
    x = F.array(*[F.col(c).cast("double") for c in features])
    return materialize(train.select(x.alias("x"), F.col("label").cast("double").alias("t"), fold_of(keys, folds).cast("int").alias("fold")), "svm-rows")


def fit_svm(
    rows: DataFrame,
    dim: int,
    folds: int,
    tol: float,
    max_steps: int,
    kernel: Callable[[np.ndarray], np.ndarray] | None = None,
    kernel_dim: int | None = None,
) -> Svm:
    """``rows`` as ``design`` gives them; ``kernel`` maps (n, dim) to (n, kernel_dim) in the tasks."""
    width = dim
    if kernel is not None:
        sent, width = rows.sparkSession.sparkContext.broadcast(kernel), kernel_dim

        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                phi = sent.value(matrix(b.column(0), dim))
                ends = pa.array(np.arange(0, phi.size + 1, width, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(phi.ravel())), b.column(1), b.column(2)], ["x", "t", "fold"])

        rows = materialize(rows.select("x", "t", "fold").mapInArrow(mapped, "x array<double>, t double, fold int"), "svm-kernel")
    fits = fit_linear(rows, width, "hinge", folds=folds, tol=tol, max_steps=max_steps)
    final, parts = fits[-1], fits[:-1]
    w, b0 = np.stack([f.weights for f in parts]), np.array([f.intercept for f in parts])
    counts = rows.agg(F.count_if(F.col("t") > 0.5).alias("pos"), F.count_if(F.col("t") <= 0.5).alias("neg")).first()
    high, low = platt_targets(counts["pos"], counts["neg"])

    def out_of_fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, t, fold = matrix(b.column(0), width), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
            margin = (x * w[fold]).sum(axis=1) + b0[fold]
            ends = pa.array(np.arange(len(margin) + 1, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(margin)), pa.array(np.where(t > 0.5, high, low))], ["x", "t"])

    schema = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("t", T.DoubleType())])
    margins = materialize(rows.select("x", "t", "fold").mapInArrow(out_of_fold, schema), "svm-margins")
    sigmoid = fit_linear(margins, 1, "logistic", reg=RIDGE, tol=1e-9)[0]
    return Svm(final, parts, float(sigmoid.weights[0]), sigmoid.intercept, kernel)
