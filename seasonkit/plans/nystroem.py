"""Nyström features of the RBF kernel: landmarks by pivoted Cholesky (Williams & Seeger 2001; Fine & Scheinberg 2001).

From a bounded sample of the rows (chosen by the hash of the vector) the row whose kernel value is explained worst becomes the next landmark,
until no sampled row is off by more than ``tol`` or ``most`` landmarks are taken. With the Cholesky factor ``L`` of the
landmarks' kernel, ``phi(x) = L^-1 k(landmarks, x)``, and ``phi(x) . phi(y)`` is the kernel's projection on the landmarks: its error falls with the
rank of the data, not with a number of random draws, and it is zero once every distinct row is a landmark.
``error`` states the worst error left on the sample. The map is a matrix product in the tasks; only the landmarks (a bounded
m x d matrix and an m x m factor) are broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of the sample that landmarks are chosen from, about.
SAMPLE = 1 << 13


def rbf(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    d2 = (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2.0 * (x @ y.T)
    return np.exp(-gamma * np.maximum(d2, 0.0))


@dataclass
class KernelMap:
    landmarks: np.ndarray
    factor: np.ndarray
    gamma: float
    error: float

    @property
    def dim(self) -> int:
        return len(self.landmarks)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """(n, d) to (n, dim)."""
        return np.linalg.solve(self.factor, rbf(self.landmarks, x, self.gamma)).T


def pivoted_cholesky(x: np.ndarray, gamma: float, most: int, tol: float) -> KernelMap:
    """The first of equally bad rows is taken, so the landmarks depend on the order of ``x`` only through ties."""
    left = np.ones(len(x))
    rows, columns = [], np.zeros((len(x), min(most, len(x))))
    while len(rows) < columns.shape[1]:
        worst = int(left.argmax())
        if left[worst] <= tol:
            break
        k = len(rows)
        column = rbf(x, x[worst : worst + 1], gamma)[:, 0] - columns[:, :k] @ columns[worst, :k]
        columns[:, k] = column / np.sqrt(left[worst])
        left = np.maximum(left - columns[:, k] ** 2, 0.0)
        rows.append(worst)
    return KernelMap(x[rows], np.tril(columns[rows, : len(rows)]), gamma, float(left.max(initial=0.0)))


def choose_landmarks(rows: DataFrame, dim: int, n: int, gamma: float, most: int, tol: float) -> KernelMap:
    """Landmarks for the column ``x`` of ``rows``. Sampled rows are sorted, so the choice doesn't depend on partitions."""
    every = max(1, n // SAMPLE)
    sample = rows.filter(F.pmod(F.xxhash64("x"), F.lit(every)) == 0).select("x").distinct()
    x = np.array(sorted(tuple(r["x"]) for r in sample.collect()), dtype=np.float64).reshape(-1, dim)  # about SAMPLE rows
    return pivoted_cholesky(x, gamma, most, tol)
