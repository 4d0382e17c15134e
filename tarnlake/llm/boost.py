"""Histogram gradient-boosted trees, flattened into arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Boosted:
    """Complete trees of one depth: node n of a tree has the children 2n + 1 and 2n + 2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; above it goes right
    value: np.ndarray  # trees x leaves
    base: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        """Of label 1 for each row, all rows walking down a tree together."""
        total, rows, inner = np.full(len(x), self.base), np.arange(len(x)), self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(inner.bit_length()):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def fit_boosted(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, l2: float = 1.0, least: float = 1.0) -> Boosted:
    """Logistic loss, second-order gains over quantile bins, level by level."""
    n, width = x.shape
    share = float(np.clip(y.mean() if n else 0.5, 1e-6, 1 - 1e-6))
    base = float(np.log(share / (1 - share)))
    inner, leaves = (1 << depth) - 1, 1 << depth
    if not n or y.min() == y.max():
        return Boosted(np.zeros((1, inner), np.int64), np.full((1, inner), np.inf), np.zeros((1, leaves)), base)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    # A cut lies halfway to the next value seen, so rows between two groups aren't all counted with one of them.
    cuts = []
    for f, e in enumerate(edges):
        seen = np.unique(x[:, f])
        cuts.append((e + seen[np.minimum(np.searchsorted(seen, e, side="right"), len(seen) - 1)]) / 2)
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    cell = np.arange(width) * bins + binned
    total = np.full(n, base)
    out = Boosted(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            at = ((node - first)[:, None] * (width * bins) + cell).ravel()
            g, h = (np.bincount(at, weights=np.repeat(v, width), minlength=count * width * bins).reshape(count, width, bins).cumsum(axis=2) for v in (grad, hess))
            all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + l2) + (all_g - g) ** 2 / (all_h - h + l2) - all_g**2 / (all_h + l2)
            gain[(h < least) | (all_h - h < least)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            feature, cut = best // bins, best % bins
            for i in np.flatnonzero(gain.reshape(count, -1)[np.arange(count), best] > 1e-9):
                if cut[i] < len(edges[feature[i]]):
                    out.feature[t, first + i], out.threshold[t, first + i] = feature[i], cuts[feature[i]][cut[i]]
            node = 2 * node + 1 + (x[np.arange(n), out.feature[t, node]] > out.threshold[t, node])
        g, h = (np.bincount(node - inner, weights=v, minlength=leaves) for v in (grad, hess))
        out.value[t] = -rate * g / (h + l2)
        total += out.value[t, node - inner]
    return out
