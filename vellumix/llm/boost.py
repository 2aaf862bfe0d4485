"""Gradient-boosted trees for a yes or no, small enough to be shipped to every worker."""

from __future__ import annotations

import numpy as np

BINS = 24


class Boosted:
    """Logistic loss, trees of depth ``depth`` over quantile bins, each split taken where the gain is largest."""

    def __init__(self, trees: int = 50, depth: int = 3, rate: float = 0.25, least: int = 5):
        self.trees, self.depth, self.rate, self.least = trees, depth, rate, least
        self.base = 0.0
        self.edges: list[np.ndarray] = []
        self.forest: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        x, y = np.asarray(x, float), np.asarray(y, float)
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        b = self._bin(x)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p) + 1e-6
            nodes = (1 << (self.depth + 1)) - 1
            feat, cut, value = np.full(nodes, -1), np.zeros(nodes, int), np.zeros(nodes)
            at = np.zeros(len(y), int)
            for node in range(nodes):
                rows = np.flatnonzero(at == node)
                if not len(rows):
                    continue
                gs, hs = g[rows].sum(), h[rows].sum()
                value[node] = gs / (hs + 1)
                if node >= nodes // 2 or len(rows) < 2 * self.least:
                    continue
                best = (1e-6, -1, 0)
                for j in range(x.shape[1]):
                    k = b[rows, j]
                    cg, ch, cn = (np.cumsum(np.bincount(k, weights, BINS + 1)) for weights in (g[rows], h[rows], None))
                    gain = cg**2 / (ch + 1) + (gs - cg) ** 2 / (hs - ch + 1) - gs**2 / (hs + 1)
                    gain[(cn < self.least) | (len(rows) - cn < self.least)] = 0
                    c = int(gain.argmax())
                    if gain[c] > best[0]:
                        best = (gain[c], j, c)
                if best[1] >= 0:
                    feat[node], cut[node] = best[1], best[2]
                    at[rows] = np.where(b[rows, best[1]] <= best[2], 2 * node + 1, 2 * node + 2)
            self.forest.append((feat, cut, value * self.rate))
            score += value[at] * self.rate
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, float)
        score = np.full(len(x), self.base)
        if not len(x) or not self.edges:
            return score
        b = self._bin(x)
        every = np.arange(len(x))
        for feat, cut, value in self.forest:
            at = np.zeros(len(x), int)
            for _ in range(self.depth):
                f = feat[at]
                at = np.where(f < 0, at, 2 * at + 1 + (b[every, np.maximum(f, 0)] > cut[at]))
            score += value[at]
        return score
