"""Gradient-boosted regression trees for a binary label, in numpy."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Logistic boosting with trees of fixed depth over binned features; deterministic."""

    def __init__(self, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32, least: int = 8):
        self.trees, self.depth, self.rate, self.bins, self.least = trees, depth, rate, bins, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = self._bin(x)
        score = np.zeros(len(y))
        self.model = []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, y - p, p * (1 - p))
            self.model.append(tree)
            score += self._leaf_values(binned, tree)
        return self

    def decision(self, x: np.ndarray) -> np.ndarray:
        """Log odds of label 1."""
        binned = self._bin(x)
        return sum((self._leaf_values(binned, t) for t in self.model), np.zeros(len(x)))

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)], axis=1) if len(x) else np.zeros(x.shape, int)

    def _grow(self, binned, gradient, hessian):
        nodes = 2 ** self.depth - 1
        feature, cut = np.zeros(nodes, int), np.full(nodes, 1 << 30)
        at = np.zeros(len(binned), int)
        for level in range(self.depth):
            for node in range(2 ** level - 1, 2 ** (level + 1) - 1):
                rows = np.flatnonzero(at == node)
                if len(rows) < 2 * self.least:
                    continue
                g, h = gradient[rows], hessian[rows]
                best = 1e-9
                for j in range(binned.shape[1]):
                    b = binned[rows, j]
                    gs, hs = np.cumsum(np.bincount(b, g, self.bins)), np.cumsum(np.bincount(b, h, self.bins))
                    n = np.cumsum(np.bincount(b, minlength=self.bins))
                    gain = gs ** 2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - gs[-1] ** 2 / (hs[-1] + 1)
                    gain[(n < self.least) | (n[-1] - n < self.least)] = 0
                    k = int(gain.argmax())
                    if gain[k] > best:
                        best, feature[node], cut[node] = gain[k], j, k
            at = 2 * at + 1 + (binned[np.arange(len(at)), feature[at]] > cut[at])
        leaf = at - nodes
        leaves = 2 ** self.depth
        value = self.rate * np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, hessian, leaves) + 1)
        return feature, cut, value

    def _leaf_values(self, binned, tree):
        feature, cut, value = tree
        at = np.zeros(len(binned), int)
        rows = np.arange(len(binned))
        for _ in range(self.depth):
            at = 2 * at + 1 + (binned[rows, feature[at]] > cut[at])
        return value[at - len(feature)]
