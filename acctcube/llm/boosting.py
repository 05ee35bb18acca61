"""Gradient-boosted trees for two classes, in numpy."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Logistic loss, complete trees of fixed depth over binned features."""

    def __init__(self, trees: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 32, leaf: float = 5.0):
        self.trees, self.depth, self.rate, self.bins, self.leaf = trees, depth, rate, bins, leaf
        self.base = 0.0
        self.model: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, width = x.shape
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(width)]
        # value <= cut k falls into bin k or below
        binned = np.stack([np.searchsorted(c, x[:, j]) for j, c in enumerate(cuts)], axis=1)
        score = np.full(n, self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            feature = np.zeros((1 << self.depth) - 1, np.int64)
            cut = np.full(len(feature), np.inf)
            node = np.zeros(n, np.int64)
            for level in range(self.depth):
                first, width_here = (1 << level) - 1, 1 << level
                best = np.full(width_here, 1e-6)
                at = node - first
                for j in range(width):
                    m = len(cuts[j]) + 1
                    key = at * m + binned[:, j]
                    g = np.bincount(key, grad, width_here * m).reshape(width_here, m).cumsum(axis=1)
                    h = np.bincount(key, hess, width_here * m).reshape(width_here, m).cumsum(axis=1)
                    total_g, total_h = g[:, -1:], h[:, -1:]
                    gain = g**2 / (h + self.leaf) + (total_g - g) ** 2 / (total_h - h + self.leaf) - total_g**2 / (total_h + self.leaf)
                    if m < 2:
                        continue
                    k = gain[:, :-1].argmax(axis=1)
                    value = gain[np.arange(width_here), k]
                    better = value > best
                    best[better] = value[better]
                    feature[first : first + width_here][better] = j
                    cut[first : first + width_here][better] = cuts[j][k[better]]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
            leaf = node - ((1 << self.depth) - 1)
            g, h = np.bincount(leaf, grad, 1 << self.depth), np.bincount(leaf, hess, 1 << self.depth)
            value = self.rate * g / (h + self.leaf)
            self.model.append((feature, cut, value))
            score += value[leaf]
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        score, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, value in self.model:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            score += value[node - ((1 << self.depth) - 1)]
        return score
