"""Histogram trees in numpy, flattened into arrays for vectorised traversal.

A tree of depth d is a heap of ``2 ** (d + 1) - 1`` nodes: node i has children
``2 i + 1`` and ``2 i + 2``. A node that isn't split sends every row left (its
threshold is infinite) and hands its value down, so that all rows walk d steps
without branches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """feature and threshold by (tree, inner node), value by (tree, leaf)."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def sum(self, x: np.ndarray) -> np.ndarray:
        """Sum of all trees' values for the rows of x."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        depth = self.feature.shape[1].bit_length()
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            total += value[at - len(feature)]
        return total


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Per feature, at most ``bins - 1`` thresholds between quantiles."""
    edges = []
    for column in x.T:
        cuts = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))
        edges.append(cuts[cuts < column.max()] if len(cuts) else cuts)
    return edges


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], axis=1).astype(np.int64)


def grow(codes: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, depth: int, least_h: float, penalty: float, rng: np.random.Generator | None = None, features: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One tree, level by level, from gradient and hessian histograms. With ``rng``,
    each node may only split on ``features`` features drawn for it."""
    n, m = codes.shape
    bins = max([1, *(len(e) + 1 for e in edges)])
    feature, threshold = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
    at, value = np.zeros(n, np.int64), np.zeros(1)
    limits = np.array([len(e) for e in edges])
    for level in range(depth + 1):
        nodes = 2**level
        hist = np.zeros((2, nodes, m, bins))
        for f in range(m):
            cell = at * bins + codes[:, f]
            hist[0, :, f] = np.bincount(cell, g, nodes * bins).reshape(nodes, bins)
            hist[1, :, f] = np.bincount(cell, h, nodes * bins).reshape(nodes, bins)
        total = hist[:, :, :1].sum(axis=3)
        filled = total[1, :, 0] > 0
        value = np.where(filled, -total[0, :, 0] / (total[1, :, 0] + penalty + 1e-12), np.repeat(value, 2)[:nodes] if level else 0.0)
        if level == depth:
            return feature, threshold, value
        left = np.cumsum(hist, axis=3)
        right = total[..., None] - left
        gain = left[0] ** 2 / (left[1] + penalty + 1e-12) + right[0] ** 2 / (right[1] + penalty + 1e-12) - (total[0] ** 2 / (total[1] + penalty + 1e-12))[..., None]
        gain[(left[1] < least_h) | (right[1] < least_h) | (np.arange(bins) >= limits[:, None])[None]] = -1
        if rng is not None and features is not None and features < m:
            drawn = np.argsort(rng.random((nodes, m)), axis=1) >= features
            gain[drawn] = -1
        best = gain.reshape(nodes, -1).argmax(axis=1)
        f, b = best // bins, best % bins
        split = gain.reshape(nodes, -1).max(axis=1) > 1e-9
        base = nodes - 1
        for k in np.flatnonzero(split):
            feature[base + k], threshold[base + k] = f[k], edges[f[k]][b[k]]
        at = 2 * at + (split[at] & (codes[np.arange(n), f[at]] > b[at]))
    raise AssertionError


def boost(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, least_h: float = 5.0, penalty: float = 1.0) -> tuple[float, Forest]:
    """Gradient boosting on the logistic loss: the start (log odds) and the trees."""
    rest = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(rest / (1 - rest)))
    edges = bin_edges(x, bins)
    codes, score, grown = binned(x, edges), np.full(len(x), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        feature, threshold, value = grow(codes, edges, p - y, p * (1 - p), depth, min(least_h, len(x) / 20), penalty)
        grown.append((feature, threshold, rate * value))
        score += Forest(*(a[None] for a in grown[-1])).sum(x)
    return start, Forest(*(np.stack(a) for a in zip(*grown, strict=True)))


def random_forest(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 7, bins: int = 64, seed: int = 1) -> Forest:
    """Bagged trees on random feature subsets; each tree's value is its share of ones, divided by the number of trees."""
    rng = np.random.default_rng(seed)
    edges = bin_edges(x, bins)
    codes, grown = binned(x, edges), []
    for _ in range(trees):
        weight = rng.multinomial(len(x), np.full(len(x), 1 / len(x))).astype(float)
        feature, threshold, value = grow(codes, edges, -y * weight, weight, depth, 2.0, 0.0, rng, max(1, round(x.shape[1] ** 0.5) + 1))
        grown.append((feature, threshold, value / trees))
    return Forest(*(np.stack(a) for a in zip(*grown, strict=True)))
