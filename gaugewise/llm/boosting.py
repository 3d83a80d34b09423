"""Gradient-boosted trees for a yes/no question, with numpy; small enough to send to every task."""

from __future__ import annotations

import numpy as np

DEPTH = 3
TREES = 60
RATE = 0.2
CUTS = 32
PENALTY = 1.0


def _cuts(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(column, np.linspace(0, 1, CUTS + 2)[1:-1])) for column in x.T]


class Trees:
    """A forest of complete trees: arrays of features and cuts by node, values by leaf."""

    def __init__(self) -> None:
        self.base, self.trees = 0.0, []

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > cut[node])
            out += value[node - (2**DEPTH - 1)]
        return out

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        cuts = _cuts(x)
        bins = np.stack([np.searchsorted(c, column, "left") for c, column in zip(cuts, x.T, strict=True)], axis=1)
        raw = np.full(len(x), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-raw))
            gradient, hessian = p - y, p * (1 - p)
            feature, cut = np.zeros(2**DEPTH - 1, np.int64), np.full(2**DEPTH - 1, np.inf)
            node = np.zeros(len(x), np.int64)
            for k in range(2**DEPTH - 1):
                own = node == k
                best = self._split(bins[own], gradient[own], hessian[own], cuts) if own.any() else None
                if best:
                    feature[k], cut[k] = best
                node[own] = 2 * k + 1 + (x[own, feature[k]] > cut[k])
            leaf = node - (2**DEPTH - 1)
            g, h = np.bincount(leaf, gradient, 2**DEPTH), np.bincount(leaf, hessian, 2**DEPTH)
            value = -RATE * g / (h + PENALTY)
            raw += value[leaf]
            self.trees.append((feature, cut, value))
        return self

    @staticmethod
    def _split(bins: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, cuts: list[np.ndarray]) -> tuple[int, float] | None:
        score = lambda g, h: g * g / (h + PENALTY)
        whole, best, found = score(gradient.sum(), hessian.sum()), 1e-6, None
        for f, own in enumerate(cuts):
            if not len(own):
                continue
            g = np.bincount(bins[:, f], gradient, len(own) + 1).cumsum()
            h = np.bincount(bins[:, f], hessian, len(own) + 1).cumsum()
            gain = score(g[:-1], h[:-1]) + score(g[-1] - g[:-1], h[-1] - h[:-1]) - whole
            k = int(gain.argmax())
            if gain[k] > best:
                best, found = float(gain[k]), (f, float(own[k]))
        return found


def calibrated(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic curve (raw scores, probabilities) by pooling neighbours that go down."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum of y, size, last raw
    for value, truth in zip(raw[order], y[order], strict=True):
        blocks.append([float(truth), 1.0, float(value)])
        while len(blocks) > 1 and (blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1] or blocks[-2][2] == blocks[-1][2]):
            s, n, last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, last]
    return np.array([b[2] for b in blocks]), np.array([b[0] / b[1] for b in blocks])


def probability(raw: np.ndarray, curve: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    at = np.minimum(np.searchsorted(curve[0], raw, "left"), len(curve[0]) - 1)
    return curve[1][at]
