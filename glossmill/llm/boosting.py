"""Gradient-boosted regression trees for two classes, on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Boosted:
    """`edges[f]`: inner borders of the bins; a tree is arrays of feature, bin, value by node."""

    edges: list[np.ndarray]
    base: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    depth: int

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(self.edges)], axis=1)
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, border, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (binned[rows, feature[node]] > border[node])
            out += value[node]
        return out


def train(
    x: np.ndarray, y: np.ndarray, n_trees: int = 60, depth: int = 4, rate: float = 0.2, smoothing: float = 5.0
) -> Boosted:
    """Fit the log-odds of `y` (0 or 1): Newton steps on full binary trees."""
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, f], quantiles)) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score, trees = np.full(len(x), base), []
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = y - p, p * (1 - p)
        feature = np.zeros(2**depth - 1, np.int64)
        border = np.full(2**depth - 1, BINS, np.int64)  # nothing is above it: all rows go left
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            first = 2**level - 1
            best = np.zeros(2**level)
            for f in range(x.shape[1]):
                cell = (node - first) * BINS + binned[:, f]
                g = np.bincount(cell, gradient, 2**level * BINS).reshape(-1, BINS).cumsum(axis=1)
                w = np.bincount(cell, weight, 2**level * BINS).reshape(-1, BINS).cumsum(axis=1)
                g_all, w_all = g[:, -1:], w[:, -1:]
                gain = g**2 / (w + smoothing) + (g_all - g) ** 2 / (w_all - w + smoothing)
                gain -= g_all**2 / (w_all + smoothing)
                at = gain.argmax(axis=1)
                value = gain[np.arange(2**level), at]
                better = value > best + 1e-9
                best = np.where(better, value, best)
                feature[first : first + 2**level][better] = f
                border[first : first + 2**level][better] = at[better]
            node = 2 * node + 1 + (binned[np.arange(len(x)), feature[node]] > border[node])
        n_nodes = 2 ** (depth + 1) - 1
        total, mass = np.bincount(node, gradient, n_nodes), np.bincount(node, weight, n_nodes)
        value = rate * total / (mass + smoothing)
        score += value[node]
        trees.append((feature, border, value))
    return Boosted(edges, base, trees, depth)
