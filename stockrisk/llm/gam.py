"""Generalised additive model with pairwise interactions, on binned features. Only numpy.

The model is a sum of lookup tables: one per feature, one per chosen pair of
features. Tables are learnt by cyclic boosting: round after round, each
feature in turn gets a shallow tree on its bins that fits the gradient of the
log loss, at a small step. When the features are done, the pairs whose
two-way trees reduce what is left of the loss most are boosted the same way.
Scoring looks every feature's bin up and adds.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np

BINS = 32
PAIR_BINS = 8
ROUNDS = 150
PAIR_ROUNDS = 60
STEP = 0.2
PAIRS = 5
LEAF_ROWS = 20
RIDGE = 1.0


@dataclass
class Model:
    intercept: float
    cuts: list[np.ndarray]  # inner bin edges of each feature
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray]  # coarser edges, for the pairs
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        total = np.full(len(rows), self.intercept)
        for j, (cuts, values) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += values[np.searchsorted(cuts, rows[:, j], side="right")]
        for (i, j), values in zip(self.pairs, self.pair_tables, strict=True):
            a = np.searchsorted(self.pair_cuts[i], rows[:, i], side="right")
            total += values[a, np.searchsorted(self.pair_cuts[j], rows[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a run of bins; place 0: none."""
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    if not len(gl):
        return 0.0, 0
    gr, hr, nr = g.sum() - gl, h.sum() - hl, n.sum() - nl
    gain = gl**2 / (hl + RIDGE) + gr**2 / (hr + RIDGE) - g.sum() ** 2 / (h.sum() + RIDGE)
    gain[(nl < LEAF_ROWS) | (nr < LEAF_ROWS)] = 0
    at = int(np.argmax(gain))
    return float(gain[at]), at + 1 if gain[at] > 0 else 0


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Leaf value of each bin in a tree of at most ``leaves`` leaves, grown by the best cut first."""
    spans = [(0, len(g))]
    while len(spans) < leaves:
        cuts = [(*_best_cut(g[a:b], h[a:b], n[a:b]), a, b) for a, b in spans]
        gain, at, a, b = max(cuts)
        if not at:
            break
        spans.remove((a, b))
        spans += [(a, a + at), (a + at, b)]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + RIDGE)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree that cuts both features once: four corners of the grid."""

    def corners(x: np.ndarray) -> np.ndarray:
        low = x.cumsum(0).cumsum(1)[:-1, :-1]
        rows, columns = x.sum(1).cumsum()[:-1, None], x.sum(0).cumsum()[None, :-1]
        return np.stack([low, rows - low, columns - low, x.sum() - rows - columns + low])

    out = np.zeros_like(g)
    if min(g.shape) < 2:
        return 0.0, out
    cg, ch, cn = corners(g), corners(h), corners(n)
    gain = (cg**2 / (ch + RIDGE)).sum(0) - g.sum() ** 2 / (h.sum() + RIDGE)
    gain[(cn < LEAF_ROWS).any(0)] = 0
    a, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if gain[a, b] <= 0:
        return 0.0, out
    value = -cg[:, a, b] / (ch[:, a, b] + RIDGE)
    out[: a + 1, : b + 1], out[: a + 1, b + 1 :], out[a + 1 :, : b + 1], out[a + 1 :, b + 1 :] = value
    return float(gain[a, b]), out


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    rounds: int = ROUNDS,
    pair_rounds: int = PAIR_ROUNDS,
    pairs: int = PAIRS,
    step: float = STEP,
) -> Model:
    """Learn the tables. With no rows, or rows of one label, the model is the smoothed share of label 1."""
    features = rows.shape[1]
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    total = np.full(len(labels), np.log(share / (1 - share)))
    if len(np.unique(labels)) < 2:
        empty = [np.zeros(0)] * features
        return Model(float(np.log(share / (1 - share))), empty, [np.zeros(1)] * features, empty, [], [])
    cuts = [_cuts(rows[:, j], BINS) for j in range(features)]
    pair_cuts = [_cuts(rows[:, j], PAIR_BINS) for j in range(features)]
    binned = [np.searchsorted(cuts[j], rows[:, j], side="right") for j in range(features)]
    coarse = [np.searchsorted(pair_cuts[j], rows[:, j], side="right") for j in range(features)]
    sizes = [len(c) + 1 for c in cuts]
    counts = [np.bincount(binned[j], minlength=sizes[j]) for j in range(features)]
    tables = [np.zeros(s) for s in sizes]
    intercept = float(total[0])

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return p - labels, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for j in range(features):
            g, h = gradients()
            values = step * _tree(np.bincount(binned[j], g, sizes[j]), np.bincount(binned[j], h, sizes[j]), counts[j])
            tables[j] += values
            total += values[binned[j]]

    def grid(i: int, j: int, weights: np.ndarray | None) -> np.ndarray:
        shape = len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1
        return np.bincount(coarse[i] * shape[1] + coarse[j], weights, shape[0] * shape[1]).reshape(shape).astype(float)

    g, h = gradients()
    ranked = sorted(combinations(range(features), 2), key=lambda p: -_quadrants(grid(*p, g), grid(*p, h), grid(*p, None))[0])
    chosen = ranked[:pairs]
    pair_tables = [np.zeros((len(pair_cuts[i]) + 1, len(pair_cuts[j]) + 1)) for i, j in chosen]
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(chosen):
            g, h = gradients()
            values = step * _quadrants(grid(i, j, g), grid(i, j, h), grid(i, j, None))[1]
            pair_tables[k] += values
            total += values[coarse[i], coarse[j]]
    return Model(intercept, cuts, tables, pair_cuts, chosen, pair_tables)
