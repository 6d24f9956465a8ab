"""Gradient-boosted trees and probability calibration in numpy, for small training sets."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class BoostedTrees:
    """Newton-boosted trees of fixed depth for log loss over binned features. Deterministic; ties go to the first split."""

    trees: int = 50
    depth: int = 3
    rate: float = 0.3
    bins: int = 32
    l2: float = 1.0
    base: float = 0.0
    #: Each tree: feature and cut of its inner nodes, level by level, and its leaf values.
    forest: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        n, d = x.shape
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1], method="lower")) for j in range(d)]
        binned = np.stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(d)], axis=1)  # value <= cut: that bin or below
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(rate / (1 - rate)))
        raw = np.full(n, self.base)
        inner = (1 << self.depth) - 1
        for _ in range(self.trees):
            p = sigmoid(raw)
            g, h = y - p, np.maximum(p * (1 - p), 1e-6)
            node = np.zeros(n, np.int64)
            feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
            for level in range(self.depth):
                first, count = (1 << level) - 1, 1 << level
                best = np.full(count, 1e-9)
                at = node - first
                for j in range(d):
                    if not len(cuts[j]):
                        continue
                    size = len(cuts[j]) + 1
                    key = at * size + binned[:, j]
                    gs = np.bincount(key, g, count * size).reshape(count, size).cumsum(1)
                    hs = np.bincount(key, h, count * size).reshape(count, size).cumsum(1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + self.l2) + (gt - gs) ** 2 / (ht - hs + self.l2) - gt**2 / (ht + self.l2)
                    k = gain[:, :-1].argmax(1)
                    top = gain[np.arange(count), k]
                    better = top > best
                    best[better] = top[better]
                    feature[first : first + count][better] = j
                    cut[first : first + count][better] = cuts[j][k[better]]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
            leaf = node - inner
            size = 1 << self.depth
            value = self.rate * np.bincount(leaf, g, size) / (np.bincount(leaf, h, size) + self.l2)
            raw += value[leaf]
            self.forest.append((feature, cut, value))
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.forest:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += value[node - len(feature)]
        return out


def fit_platt(raw: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept that turn raw scores of held-out rows into probabilities (Newton steps with a small ridge)."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = sigmoid(a * raw + b)
        w = p * (1 - p) + 1e-6
        grad = np.array([((y - p) * raw).sum() - 1e-2 * (a - 1), (y - p).sum() - 1e-2 * b])
        hess = np.array([[(w * raw * raw).sum() + 1e-2, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1e-2]])
        step = np.linalg.solve(hess, grad)
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-6:
            break
    return float(a), float(b)
