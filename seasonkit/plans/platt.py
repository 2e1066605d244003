"""Platt scaling of SVM margins (Platt 1999) with out-of-fold margins.

Rows are dealt to ``k`` folds by a hash of their keys (deterministic, no sampling). Each fold is scored by a model of
the other folds; the pooled margins then fit a one-feature logistic model ``p = 1 / (1 + exp(-(a * margin + b)))``
to Platt's smoothed targets ``(N+ + 1) / (N+ + 2)`` and ``1 / (N- + 2)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold_of(keys: Sequence[str], k: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in keys]), F.lit(k))


def platt_targets(positive: int, negative: int) -> tuple[float, float]:
    return (positive + 1.0) / (positive + 2.0), 1.0 / (negative + 2.0)


def platt_prob(margin: Column, a: float, b: float) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * margin + F.lit(b))))
