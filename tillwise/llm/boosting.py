"""Histogram gradient-boosted trees for two classes, in numpy.

Features are binned at quantiles; trees of fixed depth grow level by level from gradient histograms
and are flattened into arrays, in which the children of node i are 2i + 1 and 2i + 2.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Trees:
    """``feature`` and ``limit`` of the inner nodes, ``leaf`` of the last level, by tree."""

    base: float
    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row; all trees are walked side by side."""
        n_trees, inner = self.feature.shape
        trees, rows = np.arange(n_trees), np.arange(len(x))[:, None]
        node = np.zeros((len(x), n_trees), dtype=np.int64)
        for _ in range((inner + 1).bit_length() - 1):
            right = x[rows, self.feature[trees, node]] > self.limit[trees, node]
            node = 2 * node + 1 + right
        total = self.base + self.leaf[trees, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    n_trees: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    least_weight: float = 5.0,
    ridge: float = 1.0,
) -> Trees:
    """Trees for the log-odds of ``y`` = 1. Without rows, or with one class, the base alone rules."""
    n, n_features = x.shape
    inner, leaves = 2**depth - 1, 2**depth
    feature = np.zeros((n_trees, inner), dtype=np.int64)
    limit = np.full((n_trees, inner), np.inf)
    leaf = np.zeros((n_trees, leaves))
    positive = float(y.sum())
    base = float(np.log((positive + 1) / (n - positive + 1)))
    if not 0 < positive < n:
        return Trees(base, feature, limit, leaf)
    cuts = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) for f in range(n_features)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    flat = binned + np.arange(n_features) * BINS
    width = n_features * BINS
    margin = np.full(n, base)
    for t in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        slope, weight = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            width_here = 2**level
            first = width_here - 1
            cell = ((node - first)[:, None] * width + flat).ravel()
            g, h = (
                np.bincount(cell, np.repeat(v, n_features), width_here * width)
                .reshape(width_here, n_features, BINS)
                .cumsum(axis=2)
                for v in (slope, weight)
            )
            all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < least_weight) | (all_h - h < least_weight)] = 0
            best = gain.reshape(width_here, -1).argmax(axis=1)
            top = gain.reshape(width_here, -1).max(axis=1)
            split = top > 1e-6
            f, b = best // BINS, best % BINS
            for i in np.flatnonzero(split):
                if b[i] < len(cuts[f[i]]):
                    feature[t, first + i], limit[t, first + i] = f[i], cuts[f[i]][b[i]]
            right = x[np.arange(n), feature[t, node]] > limit[t, node]
            node = 2 * node + 1 + right
        end = node - inner
        g, h = (np.bincount(end, v, leaves) for v in (slope, weight))
        leaf[t] = -rate * g / (h + ridge)
        margin += leaf[t, end]
    return Trees(base, feature, limit, leaf)
