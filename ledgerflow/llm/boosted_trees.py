"""Gradient-boosted regression trees for a binary target, on binned features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Boosted:
    """Complete binary trees as arrays [tree, inner node] and [tree, leaf]; log-odds are the sum of leaves plus ``base``."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        depth = int(np.log2(self.leaf.shape[1]))
        rows, out = np.arange(len(x)), np.full(len(x), self.base)
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += leaf[at - (len(leaf) - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 1.0, least: float = 4.0) -> Boosted:
    """Logistic loss, second-order gains, features cut at quantiles."""
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    score, inner = np.full(n, base), 2**depth - 1
    feature, threshold, leaves = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            node = at - first
            best, where = np.full(width, 1e-6), [(0, np.inf, bins)] * width
            for j in range(m):
                k = len(cuts[j]) + 1
                cell = node * k + binned[:, j]
                gs = np.bincount(cell, g, width * k).reshape(width, k).cumsum(1)
                hs = np.bincount(cell, h, width * k).reshape(width, k).cumsum(1)
                ga, ha = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + ridge) + (ga - gs) ** 2 / (ha - hs + ridge) - ga**2 / (ha + ridge)
                gain[(hs < least) | (ha - hs < least)] = -1
                for w in np.flatnonzero(gain.max(1) > best):
                    b = int(gain[w].argmax())
                    best[w], where[w] = gain[w, b], (j, float(cuts[j][b]) if b < k - 1 else np.inf, b)
            for w, (j, cut, _) in enumerate(where):
                feature[t, first + w], threshold[t, first + w] = j, cut
            chosen, bound = np.array([w[0] for w in where]), np.array([w[2] for w in where])
            at = 2 * at + 1 + (binned[np.arange(n), chosen[node]] > bound[node])
        leaf = at - inner
        leaves[t] = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        score += leaves[t][leaf]
    return Boosted(base, feature, threshold, leaves)
