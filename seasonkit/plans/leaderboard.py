"""The twenty-model comparison: ten learners on all features, then the same
ten on two principal components, each scored on the test seasons.

The season table is written once to the shared folder before any fit, so the
play aggregation never reruns inside the hundreds of optimiser jobs; train
and test are filters on it. All scores land in one score table, also written
once, and every report (sweep, confusion, ROC, best picks) is a grouped
aggregate over it for all models together.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Sequence
from contextvars import copy_context
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import MODEL_CUTOFFS, RBF_GAMMA_FULL, RBF_GAMMA_PCA
from ..session import materialize
from .learners import Settings, checked, fit_score
from .pca import fit_pca

# Leaderboard name of each learner on all features and on two components.
FULL_NAMES = {
    "logit": "logit",
    "naive_bayes": "naive bayes",
    "svm": "SVM",
    "kernel_svm": "Kernel SVM",
    "mlp": "Neural Net",
    "knn": "KNN",
    "cart": "CART",
    "random_forest": "Random Forest",
    "adaboost": "Adaboost",
    "gbt": "Gradient Boosting",
}
PCA_NAMES = {
    "naive_bayes": "NB-PCA",
    "logit": "Logit-PCA",
    "knn": "KNN-PCA",
    "svm": "SVM-PCA",
    "kernel_svm": "Kernel SVM-PCA",
    "mlp": "Neural Network-PCA",
    "cart": "CART-PCA",
    "random_forest": "Random Forest-PCA",
    "adaboost": "Adaboost-PCA",
    "gbt": "Gradient Boosting-PCA",
}
SLOW_RANK = {"gbt": 0, "kernel_svm": 1, "mlp": 2, "adaboost": 3, "svm": 4, "random_forest": 5, "knn": 6}
ORDER = {name: i + 1 for i, (name, _) in enumerate(MODEL_CUTOFFS)}


def run_models(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    settings: Settings | None = None,
    kinds: Sequence[str] | None = None,
    with_pca: bool = True,
    timings: dict | None = None,
    gammas: tuple[float, float] = (RBF_GAMMA_FULL, RBF_GAMMA_PCA),
) -> DataFrame:
    """Fit every learner, score the test rows, return the written score table. ``gammas``: the kernel's width on
    all features and on two components."""
    s = settings or Settings()
    kinds = list(kinds or FULL_NAMES)
    timings = timings if timings is not None else {}
    # checked for missing values once, here; the fits read the written rows
    train = materialize(checked(train, features, keys, label=True), "checked-train")
    test = materialize(checked(test, features, keys, label=True), "checked-test")

    def one(kind, tr, te, feats, name, st):
        t0 = time.time()
        sc = materialize(fit_score(kind, tr, te, feats, keys, name, ORDER[name], st), "scores")
        timings[name] = round(time.time() - t0, 3)
        return sc

    jobs = [(k, train, test, tuple(features), FULL_NAMES[k], replace(s, rbf_gamma=gammas[0])) for k in kinds]
    if with_pca:
        t0 = time.time()
        pca = fit_pca(train, features, 2)
        keep = [*keys, "label"]
        trp = materialize(pca.transform(train, keep), "pca-train")
        tep = materialize(pca.transform(test, keep), "pca-test")
        timings["pca_2d"] = round(time.time() - t0, 3)
        jobs += [(k, trp, tep, ("pc1", "pc2"), PCA_NAMES[k], replace(s, rbf_gamma=gammas[1])) for k in kinds]
    # independent fits run as concurrent Spark jobs (as CrossValidator's
    # parallelism does); the slowest learners are submitted first
    slow_first = sorted(jobs, key=lambda j: SLOW_RANK.get(j[0], 99))
    with ThreadPoolExecutor(max_workers=max(1, s.parallelism)) as pool:
        futures = {j[4]: pool.submit(copy_context().run, one, *j) for j in slow_first}
        parts = [futures[j[4]].result() for j in jobs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("model_ord", F.col("model_ord").cast("int"))
