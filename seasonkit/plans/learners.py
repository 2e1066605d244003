"""The ten learners, fitted on a training table and applied to any other.

``fit(kind, train, features, keys, ...)`` returns a ``Fitted`` whose ``score`` adds ``p1`` (positive-class probability),
``margin`` (ranking score) and ``prediction`` (the model's own 0/1 decision) to the rows it is given: test seasons, a season left
out, or the cells of a mesh. ``fit_score`` gives them the common layout (see ``scores.py``). Tables carry the feature
columns (double), ``label`` and the row keys. Fits run distributed; only model parameters reach the driver.

| kind | method |
| --- | --- |
| logit | Newton steps, C = 1, gradient norm asserted (``newton``) |
| naive_bayes | Spark ML, Gaussian |
| svm | proximal method of multipliers, C = 1, duality gap asserted; Platt calibration (``svm``) |
| kernel_svm | the same on Nyström features of the RBF kernel (``nystroem``), or on random Fourier features |
| mlp | rectified units, Adam on whole-table gradients, early stopping (``perceptron``) |
| knn | exact 1-nearest neighbour (``operators.nearest``) |
| cart, random_forest | exact cuts to purity (``exact_trees``) |
| adaboost | boosted stumps (``boosted_stumps``) |
| gbt | depth-3 trees with Newton leaves (``boosted_trees``) |
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import required
from ..operators.nearest import nearest_neighbour
from ..schema import RBF_GAMMA_FULL
from ..session import materialize
from .boosted_stumps import fit_boosted_stumps
from .boosted_trees import fit_boosted_trees
from .exact_trees import fit_trees
from .fourier import FourierMap, draw
from .newton import LinearFit, fit_linear
from .nystroem import choose_landmarks
from .perceptron import fit_perceptron
from .platt import platt_prob
from .scores import score_rows
from .svm import Svm, design, fit_svm

KINDS = (
    "logit",
    "naive_bayes",
    "svm",
    "kernel_svm",
    "mlp",
    "knn",
    "cart",
    "random_forest",
    "adaboost",
    "gbt",
)


@dataclass
class Settings:
    """Learner settings. Logistic regression and the SVMs have C = 1."""

    logit_max_iter: int = 200
    logit_tol: float = 1e-10  # largest component of the mean objective's gradient
    svm_max_iter: int = 200
    svm_tol: float = 1e-3  # relative duality gap
    platt_folds: int = 5
    kernel_map: str = "nystroem"  # or "fourier"
    kernel_features: int = 512  # landmarks at most
    kernel_error: float = 1e-6  # landmarks are added until no sampled kernel value is off by more: a flat kernel's signal is small
    rff_features: int = 4096
    rbf_gamma: float = RBF_GAMMA_FULL
    mlp_hidden: tuple[int, ...] = (20, 10)
    mlp_max_iter: int = 1000
    mlp_rate: float = 0.02
    mlp_tol: float = 1e-4
    parallelism: int = 2  # concurrent model fits in the leaderboard: each holds plans and results at the driver
    rf_trees: int = 100
    ada_rounds: int = 50
    ada_algorithm: str = "SAMME.R"
    gbt_iters: int = 100
    gbt_depth: int = 3
    gbt_step: float = 0.1
    gbt_bins: int = 512
    seed: int = 1


@dataclass
class Fitted:
    """A fitted learner. ``apply(rows, keys)`` returns ``rows`` with ``p1``, ``margin`` and ``prediction``."""

    kind: str
    apply: Callable[[DataFrame, Sequence[str]], DataFrame]
    model: object = None

    def score(self, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        return self.apply(rows, list(keys))


def checked(df: DataFrame, features: Sequence[str], keys: Sequence[str], label: bool) -> DataFrame:
    """Keys, features and label; a missing value fails with the row's keys, for every learner."""
    y = [required("label", keys).alias("label")] if label else ["label"] if "label" in df.columns else []
    return df.select(*[k for k in keys if k not in features], *[required(c, keys).alias(c) for c in features], *y)


def _added(rows: DataFrame, p1: Column, margin: Column | None = None, prediction: Column | None = None) -> DataFrame:
    """``prediction`` is 1 where ``p1`` exceeds one half unless given."""
    out = rows.withColumn("p1", p1.cast("double"))
    out = out.withColumn("margin", (margin if margin is not None else F.col("p1")).cast("double"))
    return out.withColumn("prediction", prediction if prediction is not None else (F.col("p1") > 0.5).cast("double"))


def _rows(train: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(rid, x, t), written once: what every pass of an iterative fit reads."""
    x = F.array(*[F.col(c) for c in features])
    return materialize(train.select(F.xxhash64(*keys).alias("rid"), x.alias("x"), F.col("label").cast("double").alias("t")), "learner-rows")


def fit_logit(train: DataFrame, features: Sequence[str], keys: Sequence[str], s: Settings) -> LinearFit:
    rows = _rows(train, features, keys)
    return fit_linear(rows, len(features), "logistic", tol=s.logit_tol, max_steps=s.logit_max_iter)[0]


def fit_calibrated_svm(train: DataFrame, features: Sequence[str], keys: Sequence[str], s: Settings, kernel: bool) -> Svm:
    dim = len(features)
    rows = design(train, features, keys, s.platt_folds)
    phi = None
    if kernel and s.kernel_map == "fourier":
        phi = FourierMap(*draw(dim, s.rff_features, s.rbf_gamma, s.seed))
    elif kernel:
        phi = choose_landmarks(rows, dim, rows.count(), s.rbf_gamma, s.kernel_features, s.kernel_error)
    return fit_svm(rows, dim, s.platt_folds, s.svm_tol, s.svm_max_iter, phi, phi.dim if phi is not None else None)


def fit(kind: str, train: DataFrame, features: Sequence[str], keys: Sequence[str], settings: Settings | None = None) -> Fitted:
    """Fit one learner. ``train`` has ``keys`` (unique), ``features`` and ``label``."""
    s = settings or Settings()
    features, keys = tuple(features), list(keys)
    spark, dim = train.sparkSession, len(features)
    tr = checked(train, features, keys, label=True)
    ready = lambda df, ks: checked(df, features, ks, label=False)

    if kind == "logit":
        line = fit_logit(tr, features, keys, s)

        def logit(df, ks):
            z = line.margin(features)
            return _added(ready(df, ks), F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), z, (z > 0).cast("double"))

        return Fitted(kind, logit, line)

    if kind in ("svm", "kernel_svm"):
        svm = fit_calibrated_svm(tr, features, keys, s, kind == "kernel_svm")

        def machine(df, ks):
            df = ready(df, ks).withColumn("margin", svm.margin(spark, features))
            return _added(df, platt_prob(F.col("margin"), svm.a, svm.b), F.col("margin"), (F.col("margin") > 0).cast("double"))

        return Fitted(kind, machine, svm)

    if kind == "naive_bayes":
        va = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="error")
        nb = NaiveBayes(modelType="gaussian", featuresCol="_features").fit(va.transform(tr))

        def bayes(df, ks):
            out = nb.transform(va.transform(ready(df, ks)))
            out = _added(out, vector_to_array("probability")[1], None, F.col("prediction"))
            return out.drop("_features", "rawPrediction", "probability")

        return Fitted(kind, bayes, nb)

    if kind == "knn":

        def nearest(df, ks):
            nn = nearest_neighbour(tr, ready(df, ks), features, "label", keys, ks)
            # a merge: a broadcast of a row for each scored row would pass through the driver
            return _added(ready(df, ks).join(nn.hint("merge"), ks), F.col("nn_label"), None, F.col("nn_label")).drop("nn_label", "nn_dist")

        return Fitted(kind, nearest)

    if kind == "mlp":
        net = fit_perceptron(
            _rows(tr, features, keys), dim, s.mlp_hidden, s.seed, s.mlp_rate, tol=s.mlp_tol, max_iter=s.mlp_max_iter
        )
        return Fitted(kind, lambda df, ks: _added(ready(df, ks), net.probability(spark, features)), net)

    if kind in ("cart", "random_forest"):
        many = kind == "random_forest"
        trees = fit_trees(
            _rows(tr, features, keys), dim, s.rf_trees if many else 1, max(1, math.isqrt(dim)) if many else None, many, s.seed
        )

        def walk(df, ks):
            rows = ready(df, ks)
            return _added(rows.join(trees.probability(rows, ks, features).hint("merge"), ks), F.col("p1"))

        return Fitted(kind, walk, trees)

    if kind == "adaboost":
        ensemble = fit_boosted_stumps(tr, features, s.ada_rounds, s.ada_algorithm)

        def stumps(df, ks):
            out = ensemble.decision(ready(df, ks))
            return _added(out, F.col("p1"), F.col("margin"), (F.col("margin") > 0).cast("double"))

        return Fitted(kind, stumps, ensemble)

    if kind == "gbt":
        boosted = fit_boosted_trees(_rows(tr, features, keys), dim, s.gbt_iters, s.gbt_depth, s.gbt_step, s.gbt_bins)

        def boost(df, ks):
            df = ready(df, ks).withColumn("margin", boosted.margin(spark, features))
            z = F.col("margin")
            return _added(df, F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), z, (z > 0).cast("double"))

        return Fitted(kind, boost, boosted)

    raise ValueError(f"unknown learner {kind!r}")


def fit_score(
    kind: str,
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    model: str | None = None,
    model_ord: int = 0,
    settings: Settings | None = None,
) -> DataFrame:
    """Score table of the test rows (see ``scores.py``)."""
    scored = fit(kind, train, features, keys, settings).score(test, keys)
    return score_rows(scored, model or kind, model_ord, list(keys), F.col("p1"), F.col("margin"), F.col("prediction"))


def fit_model(kind: str, train: DataFrame, features: Sequence[str], settings: Settings | None = None) -> LinearFit:
    """The linear model itself, for its ``coefficients`` and ``intercept``."""
    s = settings or Settings()
    if kind not in ("logit", "svm"):
        raise ValueError(f"fit_model supports logit, svm; got {kind!r}")
    x = F.array(*[F.col(c).cast("double") for c in features])
    rows = materialize(train.select(x.alias("x"), F.col("label").cast("double").alias("t")), "learner-rows")
    tol, steps = (s.logit_tol, s.logit_max_iter) if kind == "logit" else (s.svm_tol, s.svm_max_iter)
    return fit_linear(rows, len(features), "logistic" if kind == "logit" else "hinge", tol=tol, max_steps=steps)[0]
