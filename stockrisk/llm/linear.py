"""Linear support vector machines, all fitted at once. Only numpy."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def fit_svms(rows: np.ndarray, targets: np.ndarray, penalty: float = 1e-4, steps: int = 200) -> np.ndarray:
    """Weights (features + 1, machines) of squared-hinge machines by accelerated gradient descent.

    ``targets`` has one column per machine: 1, -1, or 0 for a row that the
    machine doesn't learn from. The last weight is the bias.
    """
    x = np.concatenate([rows, np.ones((len(rows), 1), rows.dtype)], axis=1)
    # Each class of a machine weighs the same, however many rows it has.
    sign = np.where(targets > 0, 1, -1).astype(x.dtype)
    positive, negative = np.maximum((targets > 0).sum(0), 1), np.maximum((targets < 0).sum(0), 1)
    weight = np.where(targets > 0, 0.5 / positive, np.where(targets < 0, 0.5 / negative, 0.0)).astype(x.dtype)
    lipschitz = 2 * float(np.einsum("ij,ij->i", x, x).max(initial=0)) + penalty

    def slope(w: np.ndarray) -> np.ndarray:
        return -2 * x.T @ (weight * sign * np.maximum(1 - sign * (x @ w), 0))

    return descend(slope, np.zeros((x.shape[1], targets.shape[1]), x.dtype), lipschitz, penalty, steps if targets.any() else 0)


def descend(slope: Callable[[np.ndarray], np.ndarray], w: np.ndarray, lipschitz: float, penalty: float = 1e-4, steps: int = 200) -> np.ndarray:
    """The weights from ``w`` on by accelerated descent along ``slope``, the loss's gradient without its penalty."""
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        new = ahead - (slope(ahead) + penalty * ahead) / lipschitz
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w
