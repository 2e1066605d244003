"""Multilayer perceptron with rectified hidden units, fitted by Adam on whole-table gradients.

Every iteration is one aggregate: tasks run forward and back over their rows (NumPy, whole Arrow batches), and the
gradients are added in a tree (``tree_sum``). The parameters stay on the driver, so the result depends neither on the number
nor on the order of partitions. Inputs are standardised by the training rows' means and deviations.

Fitting ends when the loss has not improved by ``tol`` for ``patience`` iterations. A fit that reaches ``max_iter`` first says so:
``converged`` is false and a ``NotConvergedWarning`` is issued.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sums import matrix, sum_once, tree_sum

# Usual constants of Adam (Kingma & Ba 2015).
BETA1, BETA2, EPSILON = 0.9, 0.999, 1e-8


class NotConvergedWarning(UserWarning):
    """A perceptron whose loss was still falling at the limit of iterations."""


@dataclass
class Perceptron:
    layers: tuple[int, ...]
    params: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray
    losses: list[float] = field(default_factory=list)
    converged: bool = False

    def probability(self, spark, features: Sequence[str]) -> Column:
        sent = spark.sparkContext.broadcast(self)
        dim = len(features)

        def p1(x: pa.Array) -> pa.Array:
            net = sent.value
            z = forward(unpack(net.params, net.layers), (matrix(x, dim) - net.mean) / net.deviation)[-1][:, 0]
            return pa.array(sigmoid(z))

        return F.arrow_udf(p1, "double")(F.array(*[F.col(c).cast("double") for c in features]))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))


def start(layers: Sequence[int], seed: int) -> np.ndarray:
    """Uniform weights by the fan in and out of each layer (Glorot & Bengio 2010), zero biases."""
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in zip(layers, layers[1:], strict=False):
        bound = np.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), np.zeros(b)]
    return np.concatenate(parts)


def unpack(params: np.ndarray, layers: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in zip(layers, layers[1:], strict=False):
        out.append((params[at : at + a * b].reshape(a, b), params[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def forward(net: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray) -> list[np.ndarray]:
    """The input, each hidden layer after its rectifier, and the output before its sigmoid."""
    out = [x]
    for i, (w, b) in enumerate(net):
        z = out[-1] @ w + b
        out.append(np.maximum(z, 0.0) if i < len(net) - 1 else z)
    return out


def loss_and_gradient(params: np.ndarray, layers: Sequence[int], x: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Sum of the log losses of the rows, then its gradient in the order of ``params``."""
    net = unpack(params, layers)
    units = forward(net, x)
    z = units[-1][:, 0]
    back = (sigmoid(z) - t)[:, None]
    parts: list[np.ndarray] = []
    for i in range(len(net) - 1, -1, -1):
        parts = [(units[i].T @ back).ravel(), back.sum(axis=0), *parts]
        if i:
            back = (back @ net[i][0].T) * (units[i] > 0)
    return np.concatenate([[float((np.logaddexp(0.0, z) - t * z).sum())], *parts])


def fit_perceptron(
    rows: DataFrame,
    dim: int,
    hidden: Sequence[int] = (20, 10),
    seed: int = 1,
    rate: float = 0.02,
    penalty: float = 1e-4,
    tol: float = 1e-4,
    patience: int = 10,
    max_iter: int = 1000,
) -> Perceptron:
    """``rows``: ``x`` array<double> of ``dim`` and ``t`` in {0, 1}; a written table, as every iteration reads it."""

    def spread(b: pa.RecordBatch) -> np.ndarray:
        x = matrix(b.column(0), dim)
        return np.concatenate([[b.num_rows], x.sum(axis=0), (x * x).sum(axis=0)])

    s = sum_once(rows.select("x"), spread, 1 + 2 * dim)
    n = max(1.0, s[0])
    mean = s[1 : 1 + dim] / n
    deviation = np.sqrt(np.maximum(s[1 + dim :] / n - mean * mean, 0.0))
    deviation[deviation == 0] = 1.0
    layers = (dim, *hidden, 1)
    params = start(layers, seed)
    decayed = np.concatenate([np.r_[np.ones(a * b), np.zeros(b)] for a, b in zip(layers, layers[1:], strict=False)])
    first, second = np.zeros_like(params), np.zeros_like(params)
    net = Perceptron(layers, params, mean, deviation)
    best, stale = np.inf, 0
    data = rows.select("x", "t")
    for step in range(1, max_iter + 1):
        now = params.copy()

        def own(b: pa.RecordBatch, now=now) -> np.ndarray:
            return loss_and_gradient(now, layers, (matrix(b.column(0), dim) - mean) / deviation, b.column(1).to_numpy(zero_copy_only=False))

        s = tree_sum(data, own, 1 + len(params))
        net.losses.append(float(s[0] / n + penalty / (2 * n) * (decayed * params) @ params))
        stale = 0 if net.losses[-1] < best - tol else stale + 1
        best = min(best, net.losses[-1])
        if stale >= patience:
            net.converged = True
            break
        gradient = s[1:] / n + penalty / n * decayed * params
        first = BETA1 * first + (1 - BETA1) * gradient
        second = BETA2 * second + (1 - BETA2) * gradient**2
        params = params - rate * (first / (1 - BETA1**step)) / (np.sqrt(second / (1 - BETA2**step)) + EPSILON)
    if not net.converged:
        warnings.warn(f"the perceptron's loss was still falling after {max_iter} iterations", NotConvergedWarning, stacklevel=2)
    net.params = params
    return net
