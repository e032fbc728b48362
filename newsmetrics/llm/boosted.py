"""Histogram gradient-boosted trees, flattened into arrays.

Training works on a bounded matrix (the caller documents the bound); scoring is
vectorised traversal of flat node arrays and runs inside the tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """All trees in one set of node arrays; a leaf points to itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                low = x[rows, self.feature[node]] <= self.cut[node]
                node = np.where(low, self.left[node], self.right[node])
            out += self.value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def constant(p: float) -> Forest:
    """A forest without trees that always answers ``p``."""
    p = min(max(p, 1e-6), 1 - 1e-6)
    none = np.zeros(0, np.int64)
    return Forest(none, np.zeros(0), none, none, np.zeros(0), none, 0, float(np.log(p / (1 - p))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64,
        rate: float = 0.15, least_hessian: float = 2.0, ridge: float = 1.0,
        weight: np.ndarray | None = None) -> Forest:
    """Boost logistic loss with depth-wise trees over quantile histograms.

    ``weight`` is the number of rows that a row stands for (default 1). No rows, or
    one class only, gives the constant forest of the smoothed share.
    """
    if len(y) == 0:
        return constant(0.5)
    if y.min() == y.max():
        return constant((y.sum() + 0.5) / (len(y) + 1))
    weight = np.ones(len(y)) if weight is None else weight
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    code = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    share = np.average(y, weights=weight)
    bias = float(np.log(share / (1 - share)))
    margin = np.full(n, bias)
    feature, cut, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        k = len(feature)
        feature.append(0), cut.append(np.inf), left.append(k), right.append(k), value.append(0.0)
        return k

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = weight * (y - p), weight * np.maximum(p * (1 - p), 1e-9)
        roots.append(node())
        level = [(roots[-1], np.arange(n))]
        for step in range(depth + 1):
            following = []
            for k, rows in level:
                g, h = grad[rows].sum(), hess[rows].sum()
                best = (1e-3, -1, -1)
                if step < depth and h >= 2 * least_hessian:
                    for j in range(m):
                        size = len(edges[j]) + 1
                        if size == 1:
                            continue
                        gl = np.cumsum(np.bincount(code[rows, j], grad[rows], size))[:-1]
                        hl = np.cumsum(np.bincount(code[rows, j], hess[rows], size))[:-1]
                        gain = (gl ** 2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge)
                                - g ** 2 / (h + ridge))
                        gain[(hl < least_hessian) | (h - hl < least_hessian)] = -1
                        b = int(gain.argmax())
                        if gain[b] > best[0]:
                            best = (gain[b], j, b)
                if best[1] < 0:
                    value[k] = rate * g / (h + ridge)
                    margin[rows] += value[k]
                    continue
                _, j, b = best
                feature[k], cut[k] = j, edges[j][b]
                left[k], right[k] = node(), node()
                low = code[rows, j] <= b
                following += [(left[k], rows[low]), (right[k], rows[~low])]
            level = following
    return Forest(np.array(feature), np.array(cut), np.array(left), np.array(right),
                  np.array(value), np.array(roots), depth, bias)
