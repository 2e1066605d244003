"""Two-component PCA fitted on the training rows, centred but not scaled.

The covariance is a Spark aggregate (``StandardScaler`` mean + ``PCA`` over
the centred vectors); only the d×k loading matrix and the d means reach the
driver. Projection is then a plain column expression (sum of products with
literals), so it stays inside whole-stage codegen and needs no broadcast.
Each component's sign is fixed so that its largest-magnitude loading is
positive (the reference library's sign convention is arbitrary too).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class PcaModel:
    features: tuple[str, ...]
    mean: np.ndarray  # (d,)
    loadings: np.ndarray  # (d, k)
    explained_variance: np.ndarray  # (k,)

    def columns(self, prefix: str = "pc"):
        out = []
        for j in range(self.loadings.shape[1]):
            expr = None
            for i, c in enumerate(self.features):
                term = (F.col(c) - F.lit(float(self.mean[i]))) * F.lit(float(self.loadings[i, j]))
                expr = term if expr is None else expr + term
            out.append(expr.alias(f"{prefix}{j + 1}"))
        return out

    def transform(self, df: DataFrame, keep: Sequence[str], prefix: str = "pc") -> DataFrame:
        return df.select(*keep, *self.columns(prefix))


def fit_pca(train: DataFrame, features: Sequence[str], k: int = 2) -> PcaModel:
    va = VectorAssembler(inputCols=list(features), outputCol="_v", handleInvalid="error")
    v = va.transform(train.select(*features))
    scaler = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False).fit(v)
    pca = PCA(k=k, inputCol="_c", outputCol="_p").fit(scaler.transform(v))
    load = pca.pc.toArray().copy()  # (d, k)
    for j in range(load.shape[1]):
        if load[np.argmax(np.abs(load[:, j])), j] < 0:
            load[:, j] = -load[:, j]
    return PcaModel(tuple(features), scaler.mean.toArray(), load, pca.explainedVariance.toArray())
