"""Gradient-boosted trees for a yes-or-no question, on histograms of numeric features."""

from __future__ import annotations

import numpy as np


class Boosted:
    """Logistic boosting with complete trees of a fixed depth."""

    def __init__(self, rounds: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.ridge = rounds, depth, rate, bins, ridge
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], 1).astype(np.uint8)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned, share = self._binned(x), min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree = self._tree(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            score += self._leaf_values(tree, binned)
        return self

    def _tree(self, binned: np.ndarray, slope: np.ndarray, curve: np.ndarray):
        n, features = binned.shape
        inner = (1 << self.depth) - 1
        feature, cut = np.zeros(inner, np.int32), np.full(inner, 255, np.int32)
        node = np.zeros(n, np.int64)
        for level in range(self.depth):
            width, first = 1 << level, (1 << level) - 1
            best = np.full(width, 1e-6)
            for f in range(features):
                at = node * (self.bins + 1) + binned[:, f]
                g = np.bincount(at, slope, width * (self.bins + 1)).reshape(width, -1)
                h = np.bincount(at, curve, width * (self.bins + 1)).reshape(width, -1)
                gl, hl = g.cumsum(1)[:, :-1], h.cumsum(1)[:, :-1]
                gt, ht = g.sum(1, keepdims=True), h.sum(1, keepdims=True)
                gain = gl**2 / (hl + self.ridge) + (gt - gl)**2 / (ht - hl + self.ridge) - gt**2 / (ht + self.ridge)
                cuts = gain.argmax(1)
                won = gain[np.arange(width), cuts] > best
                best = np.where(won, gain[np.arange(width), cuts], best)
                feature[first:first + width][won], cut[first:first + width][won] = f, cuts[won]
            own = first + node
            node = node * 2 + (binned[np.arange(n), feature[own]] > cut[own])
        g, h = np.bincount(node, slope, inner + 1), np.bincount(node, curve, inner + 1)
        return feature, cut, self.rate * g / (h + self.ridge)

    def _leaf_values(self, tree, binned: np.ndarray) -> np.ndarray:
        feature, cut, value = tree
        node, rows = np.zeros(len(binned), np.int64), np.arange(len(binned))
        for _ in range(self.depth):
            node = 2 * node + 1 + (binned[rows, feature[node]] > cut[node])
        return value[node - len(feature)]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of yes."""
        binned = self._binned(x)
        return self.base + sum((self._leaf_values(t, binned) for t in self.trees), np.zeros(len(x)))
