"""Histogram gradient-boosted trees in numpy, trained on a bounded sample and flattened into arrays for scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Training:
    trees: int = 60
    depth: int = 4
    rate: float = 0.2
    bins: int = 48
    ridge: float = 1.0
    least_hessian: float = 2.0


@dataclass
class Forest:
    """All trees in one set of arrays. Node ``n`` of a leaf points to itself, so a walk may overstay without harm."""

    feature: np.ndarray
    threshold: np.ndarray
    below: np.ndarray
    above: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of leaf values for rows of features; all rows go down all trees together."""
        rows = np.arange(len(x))[:, None]
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.below[at], self.above[at])
        return self.base + self.value[at].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def fit(x: np.ndarray, y: np.ndarray, how: Training = Training()) -> Forest:
    """Logistic boosting. Without rows of both classes the forest is its base rate alone; equal gains: first feature, lowest cut."""
    positive = float(y.sum())
    base = np.log((positive + 1) / (len(y) - positive + 1))
    nodes: list[list] = []  # feature, threshold, below, above, value
    roots = []
    cuts = [np.unique(np.quantile(np.unique(c), np.linspace(0, 1, how.bins))) if len(c) else np.array([]) for c in x.T]
    cuts = [(c[1:] + c[:-1]) / 2 for c in cuts]
    bins = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], axis=1) if len(x) else np.zeros(x.shape, int)
    margin = np.full(len(y), base)

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int) -> int:
        here = len(nodes)
        nodes.append([0, np.inf, here, here, 0.0])
        g_all, h_all = g[rows].sum(), h[rows].sum()
        best, top = None, 1e-6
        if depth:
            for f, cut in enumerate(cuts):
                b = bins[rows, f]
                g_low = np.cumsum(np.bincount(b, g[rows], len(cut) + 1))[:-1]
                h_low = np.cumsum(np.bincount(b, h[rows], len(cut) + 1))[:-1]
                gain = g_low**2 / (h_low + how.ridge) + (g_all - g_low) ** 2 / (h_all - h_low + how.ridge) - g_all**2 / (h_all + how.ridge)
                gain[(h_low < how.least_hessian) | (h_all - h_low < how.least_hessian)] = -1
                if len(gain) and gain.max() > top:
                    top, best = gain.max(), (f, int(gain.argmax()))
        if best is None:
            nodes[here][4] = value = -how.rate * g_all / (h_all + how.ridge)
            margin[rows] += value
            return here
        f, k = best
        low = bins[rows, f] <= k
        nodes[here][:2] = [f, cuts[f][k]]
        nodes[here][2] = grow(rows[low], g, h, depth - 1)
        nodes[here][3] = grow(rows[~low], g, h, depth - 1)
        return here

    for _ in range(how.trees if 0 < positive < len(y) else 0):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), how.depth))
    columns = list(zip(*nodes)) if nodes else [[0], [np.inf], [0], [0], [0.0]]
    return Forest(
        np.array(columns[0], np.int64), np.array(columns[1], float), np.array(columns[2], np.int64), np.array(columns[3], np.int64),
        np.array(columns[4], float), np.array(roots or [0], np.int64), how.depth, float(base),
    )
