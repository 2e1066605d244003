"""Linear models by Newton steps: one aggregate a step, several models at once.

Logistic regression and the linear support vector machine minimise ``sum of losses + reg / 2 * |w|^2`` with a free
intercept. Each step sums losses, gradients and Hessians (their upper triangles) of all rows in one aggregate; a large model's
(d + 1) x (d + 1) system is solved in the task that added it (``block_sums``), so the driver gets and holds a few vectors of
d + 1 a model, never rows or systems. Several models that leave out one fold each share
the aggregate: the k folds of a calibration and the final model take as many passes as one of them.

* **logistic**: converged when no component of the mean objective's gradient exceeds ``tol``. Targets may lie
  between 0 and 1, as Platt's do.
* **hinge**: by the proximal method of multipliers (Rockafellar 1976). The hinge is replaced by
  ``max over a in [0, 1] of a * short - width / 2 * (a - a0)^2``, smooth, with the dual variables ``a0`` of the round before; a round
  ends with its Newton optimum, whose ``a`` are the next round's, until the **duality gap** of the plain hinge
  is at most ``tol`` of the objective. A row's dual variable follows from the weights that ended the earlier rounds (a few),
  so no state is kept by row, and the gap is a by-product of each step's sums.

A fit that ends at its limit of steps raises ``NotConverged``; it is never returned silently.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sums import block_sums, matrix, sum_once, tree_sum  # noqa: F401 (a test adds the blocks by tree_sum)


class NotConverged(RuntimeError):
    """A fit that reached its limit of steps."""


@dataclass
class LinearFit:
    """Weights (d) and intercept; the final gradient norm (logistic) or relative duality gap (hinge); steps taken."""

    weights: np.ndarray
    intercept: float
    residual: float
    steps: int
    objective: float

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.weights)

    def margin(self, features: Sequence[str]) -> Column:
        out = F.lit(float(self.intercept))
        for c, w in zip(features, self.weights, strict=True):
            out = out + F.col(c).cast("double") * F.lit(float(w))
        return out


#: First width of the proximal term, and what a round leaves of it.
WIDTH, SHRINK = 2.0, 0.5


def logistic_terms(z: np.ndarray, t: np.ndarray):
    """Loss, slope, curvature at margins ``z`` for targets ``t`` in [0, 1]."""
    p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
    return np.logaddexp(0.0, z) - t * z, p - t, p * (1.0 - p)


def hinge_duals(short: np.ndarray, before: np.ndarray, width: float) -> np.ndarray:
    """Dual variables after a round of ``width`` that began with ``before``, at ``short = 1 - y * margin``."""
    return np.clip(before + short / width, 0.0, 1.0)


def hinge_terms(short: np.ndarray, before: np.ndarray, width: float):
    """Loss, dual variable, curvature of the proximal hinge."""
    a = hinge_duals(short, before, width)
    return a * short - width / 2 * (a - before) ** 2, a, np.where((a > 0) & (a < 1), 1.0 / width, 0.0)


def moments(rows: DataFrame, dim: int) -> tuple[int, np.ndarray]:
    """(rows, mean of ``x``)."""
    sums = sum_once(rows.select("x"), lambda b: np.append(b.num_rows, matrix(b.column(0), dim).sum(axis=0)), dim + 1)
    return int(sums[0]), sums[1:] / max(1.0, sums[0])


def fit_linear(
    rows: DataFrame,
    dim: int,
    loss: str,
    reg: float = 1.0,
    folds: int = 0,
    tol: float = 1e-7,
    max_steps: int = 200,
) -> list[LinearFit]:
    """``folds`` models, each fitted on the rows whose ``fold`` is another one, and one fitted on all rows.

    ``rows`` has ``x`` array<double> of ``dim``, ``t`` (target) and, with folds, ``fold`` int; it should be a written table, as
    every step reads it. Rows are shifted by their mean while fitting, which changes nothing but the intercept.
    """
    if loss not in ("logistic", "hinge"):
        raise ValueError(f"unknown loss {loss!r}")
    n, mean = moments(rows, dim)
    m, d1 = folds + 1, dim + 1
    upper = np.triu_indices(d1)
    block = 3 + d1 + len(upper[0])
    penal = np.append(np.full(dim, reg), 0.0)
    data = rows.select("x", "t", *(["fold"] if folds else []))

    def sums(weights: np.ndarray, rounds: list[list[tuple[np.ndarray, float]]], width: np.ndarray) -> np.ndarray:
        """A row a model: loss, plain hinge, sum of dual variables, gradient of the losses, Newton step of the objective."""

        def own(b: pa.RecordBatch) -> np.ndarray:
            x = np.column_stack([matrix(b.column(0), dim) - mean, np.ones(b.num_rows)])
            t = b.column(1).to_numpy(zero_copy_only=False)
            fold = b.column(2).to_numpy(zero_copy_only=False) if folds else None
            out = np.zeros((m, block))
            for k in range(m):
                used = fold != k if folds else slice(None)
                xk, tk = x[used], t[used]
                z = xk @ weights[k]
                if loss == "hinge":
                    y = np.where(tk > 0.5, 1.0, -1.0)
                    duals = np.zeros(len(y))
                    for w, earlier in rounds[k]:
                        duals = hinge_duals(1.0 - y * (xk @ w), duals, earlier)
                    short = 1.0 - y * z
                    value, a, bend = hinge_terms(short, duals, width[k])
                    slope = -y * a
                    out[k, 1], out[k, 2] = np.maximum(0.0, short).sum(), a.sum()
                else:
                    value, slope, bend = logistic_terms(z, tk)
                out[k, 0] = value.sum()
                out[k, 3 : 3 + d1] = slope @ xk
                bent = np.flatnonzero(bend)
                xb = xk[bent]
                out[k, 3 + d1 :] = (xb.T @ (xb * bend[bent, None]))[upper]
            return out.ravel()

        def solved(k: int, s: np.ndarray) -> np.ndarray:
            bend = np.zeros((d1, d1))
            bend[upper] = s[3 + d1 :]
            bend = np.triu(bend) + np.triu(bend, 1).T + np.diag(penal)
            bend[dim, dim] += 1e-9 * max(1.0, n)  # with no row in the bend the intercept would be free
            return np.concatenate([s[: 3 + d1], -np.linalg.solve(bend, s[3 : 3 + d1] + penal * weights[k])])

        return block_sums(data, own, m, block, solved)

    weights, step = np.zeros((m, d1)), np.zeros((m, d1))
    rounds: list[list[tuple[np.ndarray, float]]] = [[] for _ in range(m)]
    width, scale = np.full(m, WIDTH), np.ones(m)
    value, residual, objective = np.full(m, np.inf), np.full(m, np.inf), np.zeros(m)
    done = np.zeros(m, dtype=bool)

    def next_round(k: int) -> None:
        rounds[k].append((weights[k].copy(), float(width[k])))
        width[k], value[k], step[k], scale[k] = width[k] * SHRINK, np.inf, 0.0, 1.0

    for taken in range(1, max_steps + 1):
        trial = weights + scale[:, None] * step
        s = sums(trial, rounds, width)
        for k in np.flatnonzero(~done):
            w = trial[k]
            now = s[k, 0] + 0.5 * reg * (w[:dim] @ w[:dim])
            if not now <= value[k] + 1e-12 * max(1.0, abs(value[k])):
                scale[k] /= 2  # the step was too long
                if scale[k] < 1e-9:  # no shorter step goes down: the optimum in floating point
                    if loss == "hinge":
                        next_round(k)
                    elif residual[k] <= 1e3 * tol:
                        done[k] = True
                    else:
                        raise NotConverged(f"logistic: residual {residual[k]:.2e}, {tol:.0e} is asked for, and no step goes down")
                continue
            weights[k], value[k], scale[k] = w, now, 1.0
            pull = s[k, 3 : 3 + d1]
            grad = pull + penal * w
            norm = np.abs(grad).max() / max(1, n)
            if loss == "hinge":
                primal = s[k, 1] + 0.5 * reg * (w[:dim] @ w[:dim])
                dual = s[k, 2] - 0.5 * (pull[:dim] @ pull[:dim]) / reg
                # the dual needs variables that balance: what they miss is charged at the intercept's size
                residual[k], objective[k] = (primal - dual + abs(w[dim] * pull[dim])) / max(1.0, abs(primal)), primal
                done[k] = residual[k] <= tol
                if not done[k] and norm <= 1e-7:
                    next_round(k)
                    continue
            else:
                residual[k], objective[k] = norm, now
                done[k] = norm <= tol
            step[k] = 0.0 if done[k] else s[k, 3 + d1 :]
        if done.all():
            break
    else:
        raise NotConverged(f"{loss}: residual {residual.max():.2e} after {max_steps} steps, {tol:.0e} is asked for")
    return [
        LinearFit(w[:dim].copy(), float(w[dim] - w[:dim] @ mean), float(r), taken, float(o))
        for w, r, o in zip(weights, residual, objective, strict=True)
    ]
