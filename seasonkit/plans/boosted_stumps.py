"""AdaBoost over decision stumps, real-valued variant (SAMME.R; Zhu, Zou,
Rosset & Hastie 2009) -- the reference library's default of that era -- or
the discrete variant (``algorithm="SAMME"``).

One boosting round is **one grouped aggregate**:

* once, up front: candidate split points per feature are approximate
  quantiles (one aggregate for all features; at most ``max_bins - 1`` values
  per feature reach the driver) and every training row gets its bin index per
  feature (``x <= t_k`` ⟺ ``bin <= k``); the binned table is written once to
  the shared folder;
* per round: every task adds its rows' weights by (feature, bin, class) and the
  tables of the tasks are added (``tree_sum``), so what travels is d × bins × 2
  sums, whatever the number of rows. The driver picks the split with the
  lowest weighted gini impurity (ties: lower feature, then lower split) and
  the weighted error of the stump from those totals;
* a row's weight follows from the written one and the stumps since, which a
  task applies itself; the weights are rescaled by the last known total, and
  the table is rewritten to the shared folder every ``checkpoint_every`` rounds.

Scoring uses the raw features: SAMME.R sums ``log p1 - log p0`` of the leaf
each row falls in (probabilities clipped at machine epsilon) and
``p1 = sigmoid(mean)``; SAMME sums ``alpha_m * (±1)`` and
``p1 = sigmoid(2 * sum / sum(alpha))``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .sums import matrix, tree_sum

EPS = float(np.finfo(np.float64).eps)


@dataclass
class Stump:
    feature: int
    threshold: float
    left: tuple[float, float]  # (weight of class 0, weight of class 1) in x <= threshold
    right: tuple[float, float]

    def leaf_prob(self, side) -> float:
        w0, w1 = side
        return w1 / (w0 + w1) if (w0 + w1) > 0 else 0.5


@dataclass
class BoostedStumps:
    features: tuple[str, ...]
    stumps: list[Stump] = field(default_factory=list)
    alphas: list[float] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)
    algorithm: str = "SAMME.R"

    @staticmethod
    def _log_ratio(p1: float) -> float:
        return float(np.log(max(p1, EPS)) - np.log(max(1.0 - p1, EPS)))

    def values(self, i: int) -> tuple[float, float]:
        """What stump ``i`` adds to the margin, left and right."""
        st, a = self.stumps[i], self.alphas[i]
        pl, pr = st.leaf_prob(st.left), st.leaf_prob(st.right)
        if self.algorithm == "SAMME.R":
            return self._log_ratio(pl), self._log_ratio(pr)
        return a * (1.0 if pl > 0.5 else -1.0), a * (1.0 if pr > 0.5 else -1.0)

    def term(self, i: int, goes_left: Column) -> Column:
        lv, rv = self.values(i)
        return F.when(goes_left, F.lit(lv)).otherwise(F.lit(rv))

    def margin(self) -> Column:
        total = None
        for i, st in enumerate(self.stumps):
            t = self.term(i, F.col(self.features[st.feature]) <= F.lit(st.threshold))
            total = t if total is None else total + t
        if self.algorithm == "SAMME.R":
            return total / F.lit(float(len(self.stumps)))
        return total / F.lit(float(sum(self.alphas)))

    def p1(self, margin: Column) -> Column:
        k = 1.0 if self.algorithm == "SAMME.R" else 2.0
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.lit(k) * margin))

    def decision(self, df: DataFrame) -> DataFrame:
        """Add ``margin`` (the ensemble's decision value) and ``p1``."""
        out = df.withColumn("margin", self.margin())
        return out.withColumn("p1", self.p1(F.col("margin")))


def split_points(train: DataFrame, features: Sequence[str], max_bins: int) -> list[np.ndarray]:
    probs = [i / max_bins for i in range(1, max_bins)]
    row = train.agg(*[F.percentile_approx(F.col(c), probs, 10000).alias(c) for c in features]).first()
    return [np.unique(np.asarray(row[c], dtype=np.float64)) for c in features]


def _below(x: Column):
    return lambda t: t < x


def _bin_column(features: Sequence[str], cuts: list[np.ndarray]) -> Column:
    bins = []
    for c, ts in zip(features, cuts):
        arr = F.array(*[F.lit(float(t)) for t in ts]) if len(ts) else F.array().cast("array<double>")
        bins.append(F.size(F.filter(arr, _below(F.col(c)))))
    return F.array(*bins)


def _best_split(tot: np.ndarray, cuts: list[np.ndarray]):
    """tot[j, b, y] = weight of class y in bin b of feature j. Lowest weighted
    gini over all (feature, split); returns (j, k, left, right)."""
    best = None
    for j, ts in enumerate(cuts):
        if len(ts) == 0:
            continue
        nb = len(ts) + 1
        cum = np.cumsum(tot[j, :nb, :], axis=0)  # (nb, 2) left totals for split k = bin index
        all_ = cum[-1]
        left = cum[:-1]  # split k: bins 0..k go left
        right = all_[None, :] - left
        nl, nr = left.sum(1), right.sum(1)
        with np.errstate(invalid="ignore", divide="ignore"):
            gl = 1.0 - ((left / nl[:, None]) ** 2).sum(1)
            gr = 1.0 - ((right / nr[:, None]) ** 2).sum(1)
        imp = np.where(nl > 0, nl * gl, 0.0) + np.where(nr > 0, nr * gr, 0.0)
        valid = (nl > 0) & (nr > 0)
        if not valid.any():
            continue
        imp = np.where(valid, imp, np.inf)
        k = int(np.argmin(imp))
        if best is None or imp[k] < best[0] - 1e-15 * max(1.0, abs(best[0])):
            best = (imp[k], j, k, tuple(left[k]), tuple(right[k]))
    if best is None:
        return None
    return best[1:]


def fit_boosted_stumps(
    train: DataFrame,
    features: Sequence[str],
    n_rounds: int = 50,
    algorithm: str = "SAMME.R",
    learning_rate: float = 1.0,
    max_bins: int = 64,
    checkpoint_every: int = 10,
) -> BoostedStumps:
    """``train`` has the feature columns (double) and a 0/1 ``label``."""
    features = tuple(features)
    d = len(features)
    cuts = split_points(train, features, max_bins)
    nbmax = max(len(t) for t in cuts) + 1
    n = train.count()
    cur = materialize(
        train.select(_bin_column(features, cuts).alias("bins"), F.col("label").cast("double").alias("label")).withColumn(
            "w", F.lit(1.0 / n)
        ),
        "boost-weights",
    )
    model = BoostedStumps(features=features, algorithm=algorithm)
    fresh: list[tuple[int, int, np.ndarray, float]] = []

    def weighed(b: pa.RecordBatch, since: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bins, y = matrix(b.column(0), d), (b.column(1).to_numpy(zero_copy_only=False) == 1).astype(int)
        w = b.column(2).to_numpy(zero_copy_only=False)
        for j, k, power, total in since:
            w = w * np.exp(power[(bins[:, j] > k).astype(int), y]) / total
        return bins, y, w

    def rewritten(batches: Iterator[pa.RecordBatch], since: tuple) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(weighed(b, since)[2])], ["bins", "label", "w"])

    for r in range(n_rounds):

        def own(b: pa.RecordBatch, since=tuple(fresh)) -> np.ndarray:
            bins, y, w = weighed(b, since)
            at = ((np.arange(d)[None] * nbmax + bins) * 2 + y[:, None]).ravel()
            return np.bincount(at, np.repeat(w, d), minlength=d * nbmax * 2)

        tot = tree_sum(cur, own, d * nbmax * 2).reshape(d, nbmax, 2)
        total_w = float(tot[0].sum())
        found = _best_split(tot, cuts)
        if found is None:
            break
        j, k, left, right = found
        stump = Stump(j, float(cuts[j][k]), left, right)
        # weighted error of the stump's class decision in each leaf
        err = (min(left) + min(right)) / total_w
        model.errors.append(err)
        sides = (stump.leaf_prob(left), stump.leaf_prob(right))
        if algorithm == "SAMME.R":
            model.stumps.append(stump)
            model.alphas.append(1.0)
            if err <= 0 or r == n_rounds - 1:
                break
            lv, rv = model.values(len(model.stumps) - 1)
            power = -0.5 * learning_rate * np.outer([lv, rv], [-1.0, 1.0])  # by side and class
        else:
            if err <= 0:
                model.stumps.append(stump)
                model.alphas.append(1.0)
                break
            if err >= 0.5:
                if not model.stumps:
                    raise ValueError("first weak learner is no better than chance")
                break
            alpha = learning_rate * float(np.log((1.0 - err) / err))
            model.stumps.append(stump)
            model.alphas.append(alpha)
            if r == n_rounds - 1:
                break
            power = alpha * np.array([[p > 0.5, p <= 0.5] for p in sides], dtype=np.float64)
        fresh.append((j, k, power, total_w))
        if (r + 1) % checkpoint_every == 0:
            done = tuple(fresh)
            cur = materialize(cur.mapInArrow(lambda it, done=done: rewritten(it, done), "bins array<int>, label double, w double"), "boost-weights")
            fresh = []
    return model
