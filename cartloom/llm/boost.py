"""Gradient-boosted decision trees for two classes, on histogram bins, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Boosted:
    """Trees of fixed depth over binned features; leaves add up to the log odds."""

    edges: list[np.ndarray] = field(default_factory=list)
    features: np.ndarray | None = None  # (trees, inner nodes)
    cuts: np.ndarray | None = None
    leaves: np.ndarray | None = None
    base: float = 0.0
    depth: int = 4

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, ridge: float = 2.0) -> Boosted:
        model = Boosted(depth=depth)
        model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = model._bin(x)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        model.base = float(np.log(share / (1 - share)))
        score = np.full(len(y), model.base)
        inner = 2**depth - 1
        model.features, model.cuts = np.zeros((trees, inner), np.int16), np.full((trees, inner), 255, np.uint8)
        model.leaves = np.zeros((trees, inner + 1))
        width = x.shape[1]
        flat = binned.astype(np.int64) + np.arange(width) * BINS
        for t in range(trees):
            p = 1 / (1 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            for level in range(depth):
                first, count = 2**level - 1, 2**level
                size = width * BINS
                cell = (node[:, None] * size + flat).ravel()
                g = np.bincount(cell, np.repeat(grad, width), count * size).reshape(count, width, BINS)
                h = np.bincount(cell, np.repeat(hess, width), count * size).reshape(count, width, BINS)
                gl, hl = g.cumsum(axis=2), h.cumsum(axis=2)
                gt, ht = gl[:, :, -1:], hl[:, :, -1:]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                best = gain.reshape(count, -1).argmax(axis=1)
                worth = gain.reshape(count, -1).max(axis=1) > 1e-6
                model.features[t, first : first + count] = best // BINS
                model.cuts[t, first : first + count] = np.where(worth, best % BINS, 255)
                at = first + node
                right = binned[np.arange(len(y)), model.features[t, at]] > model.cuts[t, at]
                node = node * 2 + right
            g, h = np.bincount(node, grad, inner + 1), np.bincount(node, hess, inner + 1)
            model.leaves[t] = rate * g / (h + ridge)
            score += model.leaves[t][node]
        return model

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        binned, rows = self._bin(x), np.arange(len(x))
        score = np.full(len(x), self.base)
        for t in range(len(self.leaves)):
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = 2**level - 1 + node
                node = node * 2 + (binned[rows, self.features[t, at]] > self.cuts[t, at])
            score += self.leaves[t][node]
        return score
