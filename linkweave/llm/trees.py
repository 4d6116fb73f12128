"""Small gradient-boosted trees in numpy, for models trained on a bounded sample and applied inside tasks."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Tree:
    """A complete binary tree: split features and bounds by node, then leaf values."""

    feature: np.ndarray
    bound: np.ndarray
    leaf: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        for _ in range(len(self.leaf).bit_length() - 1):
            at = 2 * at + 1 + (x[rows, self.feature[at]] > self.bound[at])
        return self.leaf[at - len(self.feature)]


@dataclass
class Boosted:
    start: float
    rate: float
    trees: list[Tree] = field(default_factory=list)

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.start)
        for t in self.trees:
            total += self.rate * t.predict(x)
        return 1.0 / (1.0 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3, bins: int = 32, ridge: float = 1.0) -> Boosted:
    """Logistic boosting with second-order leaf values; splits at quantiles of each feature."""
    share = float(np.clip(y.mean() if len(y) else 0.0, 1e-3, 1 - 1e-3))
    model = Boosted(float(np.log(share / (1 - share))), rate)
    if not len(y):
        return model
    bounds = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    coded = np.stack([np.searchsorted(b, c, side="left") for b, c in zip(bounds, x.T, strict=True)], 1)
    total = np.full(len(y), model.start)
    for _ in range(trees):
        p = 1.0 / (1.0 + np.exp(-total))
        tree = _grow(coded, bounds, y - p, p * (1 - p), depth, ridge)
        model.trees.append(tree)
        total += rate * tree.predict(x)
    return model


def _grow(coded: np.ndarray, bounds: list, grad: np.ndarray, hess: np.ndarray, depth: int, ridge: float) -> Tree:
    inner = (1 << depth) - 1
    feature, bound = np.zeros(inner, np.int64), np.full(inner, np.inf)
    at = np.zeros(len(grad), np.int64)
    for node in range(inner):
        here = np.flatnonzero(at == node)
        best = (1e-9, 0, np.inf, None)
        g, h = grad[here].sum(), hess[here].sum()
        for f, cuts in enumerate(bounds):
            if not len(here) or not len(cuts):
                continue
            code = coded[here, f]
            gl = np.cumsum(np.bincount(code, grad[here], len(cuts) + 1))[:-1]
            hl = np.cumsum(np.bincount(code, hess[here], len(cuts) + 1))[:-1]
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], f, cuts[k], code > k)
        _, feature[node], bound[node], right = best
        at[here] = 2 * node + 1 + (right if right is not None else 0)
    leaf = np.zeros(inner + 1)
    for n in range(inner + 1):
        here = at == inner + n
        if here.any():
            leaf[n] = grad[here].sum() / (hess[here].sum() + ridge)
    return Tree(feature, bound, leaf)
