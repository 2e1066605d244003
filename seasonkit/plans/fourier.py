"""Random Fourier features of the RBF kernel (Rahimi & Recht, 2007).

``z(x) = sqrt(2 / D) * cos(W x + b)`` with ``W ~ N(0, 2 * gamma * I)`` and
``b ~ U(0, 2 pi)`` drawn once from a seed on the driver (a d×D matrix, bounded
by the chosen D), so ``z(x) . z(y)`` approximates ``exp(-gamma |x - y|^2)``.
The alternative to the Nyström map of ``nystroem``: it needs no look at the data, but its error
falls only with the root of D.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def draw(dim: int, n_features: int, gamma: float, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(dim, n_features))
    b = rng.uniform(0.0, 2.0 * np.pi, size=n_features)
    return w, b


@dataclass
class FourierMap:
    w: np.ndarray
    b: np.ndarray

    @property
    def dim(self) -> int:
        return len(self.b)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """(n, d) to (n, dim)."""
        return np.sqrt(2.0 / self.dim) * np.cos(x @ self.w + self.b)
