"""Gradient-boosted trees for two classes, in numpy: binned features, complete trees of fixed depth."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """``feature`` and ``limit`` of the inner nodes and ``leaf`` values, one row per tree; a row goes right above the limit."""

    start: float
    feature: np.ndarray
    limit: np.ndarray
    leaf: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        rows, total = np.arange(len(x)), np.full(len(x), self.start, np.float32)
        inner = self.feature.shape[1]
        depth = inner.bit_length()
        for feature, limit, leaf in zip(self.feature, self.limit, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > limit[at])
            total += leaf[at - inner]
        return total


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 32, smooth: float = 5.0) -> Trees:
    """Logistic loss, second-order leaf values; ``smooth`` is added to the weight of each leaf and bounds small ones."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    width = x.shape[1]
    cells = binned + np.arange(width) * bins
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    total = np.full(len(y), start)
    inner = 2**depth - 1
    model = Trees(start, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, inner + 1), np.float32))
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            place = ((at - first)[:, None] * (width * bins) + cells).ravel()
            size = count * width * bins
            g = np.bincount(place, np.repeat(grad, width), size).reshape(count, width, bins)
            h = np.bincount(place, np.repeat(hess, width), size).reshape(count, width, bins)
            gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
            ga, ha = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + smooth) + (ga - gl) ** 2 / (ha - hl + smooth) - ga**2 / (ha + smooth)
            best = gain.reshape(count, -1).argmax(axis=1)
            for k in range(count):
                f, b = divmod(int(best[k]), bins)
                if gain[k, f, b] > 1e-6 and b < len(edges[f]):
                    model.feature[t, first + k], model.limit[t, first + k] = f, edges[f][b]
            f = model.feature[t, at]
            at = 2 * at + 1 + (x[np.arange(len(y)), f] > model.limit[t, at])
        leaf = at - inner
        g, h = (np.bincount(leaf, v, inner + 1) for v in (grad, hess))
        model.leaf[t] = rate * g / (h + smooth)
        total += model.leaf[t, leaf]
    return model
