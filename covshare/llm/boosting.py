"""Gradient-boosted trees on a bounded sample, flattened for scoring.

Training is on binned features with logistic loss, one level at a time.
Features can be held to a direction: a split that would go against it is not
taken, and the bounds that a taken split sets hold for everything below it, so
the score is monotone in such a feature whatever the others are.

A fitted model is five arrays over (tree, node) in heap order: children of node
i are 2 i + 1 and 2 i + 2. Scoring moves all rows down one level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

MOST_ROWS = 1_000_000  # a fit is refused beyond; samples are bounded by the callers


@dataclass(frozen=True)
class Trees:
    feature: np.ndarray  # (tree, node), -1 at a leaf
    threshold: np.ndarray  # go left if the value is at most that
    value: np.ndarray  # of a leaf, in log odds
    base: float
    depth: int

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Scores of the rows of x; NaN goes left."""
        n_trees = len(self.feature)
        tree = np.arange(n_trees)
        node = np.zeros((len(x), n_trees), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            feature = self.feature[tree, node]
            inner = feature >= 0
            right = x[rows, np.maximum(feature, 0)] > self.threshold[tree, node]
            node = np.where(inner, 2 * node + 1 + right, node)
        return self.base + self.value[tree, node].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.log_odds(x)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    monotone: dict[int, int] | None = None,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.15,
    bins: int = 64,
    ridge: float = 1.0,
    least_weight: float = 2.0,
) -> Trees:
    """Fit P(y = 1); `monotone` gives +1 or -1 for the features held to a direction.

    Without rows, or with one class only, the model is that class's rate.
    """
    if len(x) > MOST_ROWS:
        raise ValueError(f"fit on a sample of {MOST_ROWS} rows at most")
    n, width = x.shape
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1, np.int64)
    threshold = np.zeros((trees, nodes))
    value = np.zeros((trees, nodes))
    rate_of_y = (y.sum() + 0.5) / (n + 1)
    base = float(np.log(rate_of_y / (1 - rate_of_y)))
    if n == 0 or y.min() == y.max():
        return Trees(feature, threshold, value, base, depth)
    x = np.nan_to_num(np.asarray(x, float), nan=-np.inf, posinf=np.finfo(float).max)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    most = bins + 1
    flat = binned + np.arange(width) * most
    direction = np.zeros(width)
    for j, d in (monotone or {}).items():
        direction[j] = d
    score = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        bounds = {0: (-np.inf, np.inf)}
        for level in range(depth + 1):
            first = 2**level - 1
            for i in range(first, 2 * first + 1):
                if i not in bounds:
                    continue
                low, high = bounds[i]
                rows = np.flatnonzero(node == i)
                g, h = gradient[rows], weight[rows]
                own = float(np.clip(g.sum() / (h.sum() + ridge), low, high))
                value[t, i] = rate * own
                found = _split(flat[rows], g, h, width, most, direction, low, high, ridge, least_weight, edges) if level < depth else None
                if found is None:
                    continue
                j, cut, left_value, right_value = found
                feature[t, i], threshold[t, i] = j, edges[j][cut]
                middle = (left_value + right_value) / 2
                left, right = (low, high), (low, high)
                if direction[j] > 0:
                    left, right = (low, middle), (middle, high)
                elif direction[j] < 0:
                    left, right = (middle, high), (low, middle)
                bounds[2 * i + 1], bounds[2 * i + 2] = left, right
                node[rows] = 2 * i + 1 + (binned[rows, j] > cut)
        score = score + value[t, node]
    value[feature >= 0] = 0
    return Trees(feature, threshold, value, base, depth)


def _split(flat, g, h, width, most, direction, low, high, ridge, least_weight, edges):
    """The best split of some rows: (feature, bin, left value, right value) or None."""
    size = width * most
    at = flat.ravel()
    sums = [np.bincount(at, np.repeat(v, width), size).reshape(width, most) for v in (g, h)]
    left_g, left_h = (s.cumsum(axis=1)[:, :-1] for s in sums)
    all_g, all_h = g.sum(), h.sum()
    right_g, right_h = all_g - left_g, all_h - left_h
    left = np.clip(left_g / (left_h + ridge), low, high)
    right = np.clip(right_g / (right_h + ridge), low, high)

    def gain(total_g, total_h, v):
        return total_g * v - 0.5 * (total_h + ridge) * v * v

    better = gain(left_g, left_h, left) + gain(right_g, right_h, right)
    better = better - gain(all_g, all_h, np.clip(all_g / (all_h + ridge), low, high))
    better[(left_h < least_weight) | (right_h < least_weight)] = -np.inf
    better[(right - left) * direction[:, None] < 0] = -np.inf
    better[np.arange(most - 1)[None, :] >= np.asarray([len(e) for e in edges])[:, None]] = -np.inf
    j, cut = np.unravel_index(np.argmax(better), better.shape)
    if better[j, cut] <= 1e-9:
        return None
    return int(j), int(cut), float(left[j, cut]), float(right[j, cut])
