"""Gradient-boosted trees for several classes on a bounded table of features, in numpy."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Softmax boosting with trees of fixed depth on binned features; ``temperature`` calibrates the probabilities."""

    def __init__(self, classes: tuple[str, ...], rounds: int = 40, depth: int = 3, rate: float = 0.25, bins: int = 32, least: float = 3.0, ridge: float = 1.0):
        self.classes, self.rounds, self.depth, self.rate, self.bins, self.least, self.ridge = classes, rounds, depth, rate, bins, least, ridge
        self.trees: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []
        self.temperature = 1.0
        self.prior = np.zeros(len(classes))

    def _tree(self, binned: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, width = binned.shape
        node, size = np.zeros(n, np.int64), 1
        feature, cut = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)
        for level in range(self.depth):
            base = size - 1
            best = np.full(size, 1e-6)
            at = np.full((size, 2), -1)
            for f in range(width):
                if len(edges[f]) == 0:
                    continue
                key = node * self.bins + binned[:, f]
                gs = np.bincount(key, g, size * self.bins).reshape(size, -1).cumsum(1)
                hs = np.bincount(key, h, size * self.bins).reshape(size, -1).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + self.ridge) + (gt - gs) ** 2 / (ht - hs + self.ridge) - gt**2 / (ht + self.ridge)
                gain[(hs < self.least * 0.05) | (ht - hs < self.least * 0.05)] = -1
                gain = gain[:, : len(edges[f])]
                k = gain.argmax(1)
                top = gain[np.arange(size), k]
                better = top > best
                best[better] = top[better]
                at[better, 0], at[better, 1] = f, k[better]
            right = np.zeros(n, bool)
            for i in range(size):
                if at[i, 0] >= 0:
                    f, k = at[i]
                    feature[base + i], cut[base + i] = f, edges[f][k]
                    rows = node == i
                    right[rows] = binned[rows, f] > k
            node = node * 2 + right
            size *= 2
        gs, hs = np.bincount(node, g, size), np.bincount(node, h, size)
        return feature, cut, -self.rate * gs / (hs + self.ridge)

    def fit(self, x: np.ndarray, label: np.ndarray) -> BoostedTrees:
        """``label`` holds the index of each row's class."""
        k = len(self.classes)
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(x.shape[1])]
        edges = [e[e < x[:, f].max()] if len(e) else e for f, e in enumerate(edges)]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
        y = np.eye(k)[label]
        share = (y.sum(0) + 1) / (len(y) + k)
        weight = np.minimum(1 / share / k, 8)[label]
        self.prior = np.log(share)
        score = np.tile(self.prior, (len(x), 1))
        for _ in range(self.rounds):
            p = np.exp(score - score.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            grown = []
            for c in range(k):
                tree = self._tree(binned, edges, weight * (p[:, c] - y[:, c]), weight * np.maximum(p[:, c] * (1 - p[:, c]), 1e-6))
                grown.append(tree)
                score[:, c] += self._value(tree, x)
            self.trees.append(grown)
        return self

    def _value(self, tree: tuple[np.ndarray, np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
        feature, cut, leaf = tree
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
        return leaf[at - (2**self.depth - 1)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.tile(self.prior, (len(x), 1))
        for grown in self.trees:
            for c, tree in enumerate(grown):
                out[:, c] += self._value(tree, x)
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        s = self.scores(x) / self.temperature
        p = np.exp(s - s.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def calibrate(self, x: np.ndarray, label: np.ndarray) -> float:
        """The temperature of least log loss on held-out rows."""
        best = (np.inf, 1.0)
        for t in np.exp(np.linspace(-1, 2, 31)):
            self.temperature = float(t)
            best = min(best, (float(-np.log(self.probabilities(x)[np.arange(len(x)), label] + 1e-12).mean()), float(t)))
        self.temperature = best[1]
        return best[0]
