"""Gradient-boosted trees over binned features, for models small enough to train on one machine."""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Trees for the log-odds of a yes/no label, fitted on at most the rows given."""

    def __init__(self, trees: int = 50, depth: int = 4, rate: float = 0.3, least: float = 5.0, penalty: float = 1.0):
        self.n_trees, self.depth, self.rate, self.least, self.penalty = trees, depth, rate, least, penalty

    def state(self) -> dict:
        """Plain values, to send to workers."""
        return {"cuts": self.cuts, "base": self.base, "trees": self.trees, "depth": self.depth}

    @classmethod
    def of(cls, state: dict) -> Boosted:
        model = cls()
        model.__dict__.update(state)
        return model

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.cuts)], axis=1).astype(np.uint8)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        y = y.astype(np.float64)
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1])]
        p = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if not len(y) or y.min() == y.max():
            return self
        every = self.bins(x)
        score = np.full(len(y), self.base)
        for k in range(self.n_trees):
            # each tree is fitted on every other row, which halves the time and varies the trees
            half = slice(k % 2, None, 2) if len(y) > 1000 else slice(None)
            b, own = every[half], np.ascontiguousarray(every[half].T).astype(np.int32)
            prob = 1 / (1 + np.exp(-score[half]))
            g, h = y[half] - prob, prob * (1 - prob)
            feature, cut = np.zeros(2**self.depth - 1, int), np.full(2**self.depth - 1, 255, int)
            node = np.zeros(len(b), int)
            for level in range(self.depth):
                first, n = 2**level - 1, 2**level
                best = np.zeros(n)
                at = node - first
                total_g, total_h = np.bincount(at, g, n), np.bincount(at, h, n)
                for j in range(b.shape[1]):
                    cell = at * (BINS + 1) + own[j]
                    gl = np.bincount(cell, g, n * (BINS + 1)).reshape(n, BINS + 1).cumsum(1)[:, :-1]
                    hl = np.bincount(cell, h, n * (BINS + 1)).reshape(n, BINS + 1).cumsum(1)[:, :-1]
                    gr, hr = total_g[:, None] - gl, total_h[:, None] - hl
                    gain = gl**2 / (hl + self.penalty) + gr**2 / (hr + self.penalty) - (total_g**2 / (total_h + self.penalty))[:, None]
                    gain[(hl < self.least / 10) | (hr < self.least / 10)] = 0
                    k = gain.argmax(1)
                    top = gain[np.arange(n), k]
                    better = top > best + 1e-9
                    best[better] = top[better]
                    feature[first : first + n][better] = j
                    cut[first : first + n][better] = k[better]
                node = 2 * node + 1 + (b[np.arange(len(b)), feature[node]] > cut[node])
            leaf = node - (2**self.depth - 1)
            value = self.rate * np.bincount(leaf, g, 2**self.depth) / (np.bincount(leaf, h, 2**self.depth) + self.penalty)
            node = np.zeros(len(y), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (every[np.arange(len(y)), feature[node]] > cut[node])
            score += value[node - (2**self.depth - 1)]
            self.trees.append((feature, cut, value))
        return self

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        if not len(x):
            return score
        b = np.ascontiguousarray(self.bins(x).T)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[feature[node], rows] > cut[node])
            score += value[node - (2**self.depth - 1)]
        return score
