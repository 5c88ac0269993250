"""Gradient-boosted trees for two classes and isotonic calibration, on arrays.

Both are fitted on bounded samples on the driver and applied to batches of
feature rows inside tasks.
"""

from __future__ import annotations

import numpy as np


class Trees:
    """Logistic boosting of full binary trees of one depth over quantile bins."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.25, bins: int = 48, least: float = 4.0,
                 ridge: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.ridge = rounds, depth, rate, bins, least, ridge
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> "Trees":
        x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
        w = np.ones(len(y)) if weight is None else np.asarray(weight, np.float64)
        mean = float(np.clip((w * y).sum() / max(w.sum(), 1e-9), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        self.base, self.trees = float(np.log(mean / (1 - mean))), []
        if len(y) < 2 or y.min() == y.max():
            return self
        n, m = x.shape
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(m)]
        # a feature that is mostly one value still gets cuts between its other values
        cuts = [np.unique(np.concatenate([c, np.quantile(x[x[:, j] != c[0], j], [0, .25, .5, .75])]))
                if len(c) and (x[:, j] != c[0]).any() else c for j, c in enumerate(cuts)]
        wide = max(len(c) for c in cuts) + 1
        binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)  # x <= cut goes left
        flat = binned + np.arange(m) * wide
        score = np.full(n, self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            grad, hess = w * (y - p), w * p * (1 - p) + 1e-9
            node = np.zeros(n, np.int64)
            feature = np.zeros(2 ** self.depth - 1, np.int64)
            threshold = np.full(2 ** self.depth - 1, np.inf)
            for level in range(self.depth):
                first, count = 2 ** level - 1, 2 ** level
                at = ((node - first)[:, None] * (m * wide) + flat).ravel()
                g = np.bincount(at, np.repeat(grad, m), count * m * wide).reshape(count, m, wide).cumsum(2)
                h = np.bincount(at, np.repeat(hess, m), count * m * wide).reshape(count, m, wide).cumsum(2)
                G, H = g[:, :, -1:], h[:, :, -1:]
                gain = g ** 2 / (h + self.ridge) + (G - g) ** 2 / (H - h + self.ridge) - G ** 2 / (H + self.ridge)
                gain[(h < self.least / 16) | (H - h < self.least / 16)] = -1
                gain[:, :, -1] = -1
                best = gain.reshape(count, -1).argmax(1)
                for i, b in enumerate(best.tolist()):
                    j, c = divmod(b, wide)
                    if gain[i, j, c] > 1e-6 and c < len(cuts[j]):
                        feature[first + i], threshold[first + i] = j, cuts[j][c]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
            leaf = node - (2 ** self.depth - 1)
            value = (np.bincount(leaf, grad, 2 ** self.depth)
                     / (np.bincount(leaf, hess, 2 ** self.depth) + self.ridge)) * self.rate
            score += value[leaf]
            self.trees.append((feature, threshold, value))
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, np.float64)
        n = len(x)
        out = np.full(n, self.base)
        if not n:
            return out
        flat, row = x.ravel(), np.arange(n) * x.shape[1]
        for feature, threshold, value in self.trees:
            node = np.zeros(n, np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (flat.take(row + feature.take(node)) > threshold.take(node))
            out += value.take(node - (2 ** self.depth - 1))
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


class Isotonic:
    """Smallest-squares non-decreasing map of scores to frequencies (pool adjacent violators)."""

    def fit(self, score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> "Isotonic":
        order = np.argsort(score, kind="stable")
        blocks: list[list[float]] = []  # mean, weight, first score, last score
        for s, t, w in zip(score[order].tolist(), np.asarray(y, float)[order].tolist(), weight[order].tolist()):
            blocks.append([t, w, s, s])
            while len(blocks) > 1 and (blocks[-2][0] >= blocks[-1][0] or blocks[-2][3] == blocks[-1][2]):
                b = blocks.pop()
                a = blocks[-1]
                a[0] = (a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1])
                a[1] += b[1]
                a[3] = b[3]
        self.x = np.asarray([v for b in blocks for v in (b[2], b[3])] or [0.0])
        self.y = np.asarray([b[0] for b in blocks for _ in (0, 1)] or [0.5])
        return self

    def __call__(self, score: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(score, self.x, self.y), 0.0, 1.0)
