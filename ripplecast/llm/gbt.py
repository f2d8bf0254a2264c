"""Gradient-boosted trees for two classes: histogram splits, monotonic constraints, flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


@dataclass(frozen=True)
class Forest:
    """Node k of tree t: go to child[t, k] + (x[feature] > cut), leaves point at themselves."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, child, value in zip(self.feature, self.cut, self.child, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                inner = child[node] >= 0
                node = np.where(inner, child[node] + (x[rows, feature[node]] > cut[node]), node)
            out += value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(x))


def fit_forest(
    x: np.ndarray, y: np.ndarray, monotone: np.ndarray | None = None, trees: int = 60, depth: int = 3,
    rate: float = 0.15, bins: int = 64, min_rows: int | None = None, ridge: float = 1.0,
) -> Forest:
    """Boost logistic loss. monotone[f] is +1 / -1 where the score may only rise / fall with feature f.

    Splits that would break a constraint are refused, and the bounds they set
    hold for everything below them, so the whole forest is monotone. Leaves hold at
    least `min_rows` rows (default: 1 % of the rows, between 4 and 20).
    """
    n, width = x.shape
    min_rows = min_rows or max(4, min(20, n // 100))
    monotone = np.zeros(width, int) if monotone is None else monotone
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], x[:, f], "left") for f in range(width)], 1)
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    score = np.full(n, base)
    size = 2 ** (depth + 1) - 1
    out = [np.zeros((trees, size), k) for k in (np.int64, float, np.int64, float)]
    out[2][:] = -1
    for t in range(trees):
        p = sigmoid(score)
        g, h = p - y, p * (1 - p)
        feature, cut, child, value = (a[t] for a in out)
        todo, used = [(0, np.arange(n), 0, -np.inf, np.inf)], 1
        while todo:
            node, rows, level, low, high = todo.pop()
            gs, hs = g[rows], h[rows]
            total_g, total_h = gs.sum(), hs.sum()
            value[node] = rate * np.clip(-total_g / (total_h + ridge), low, high)
            best = (1e-6, None)
            if level < depth and len(rows) >= 2 * min_rows:
                for f in range(width):
                    if not len(cuts[f]):
                        continue
                    b, m = binned[rows, f], len(cuts[f]) + 1
                    lg, lh = (np.cumsum(np.bincount(b, w, m))[:-1] for w in (gs, hs))
                    count = np.cumsum(np.bincount(b, minlength=m))[:-1]
                    left = np.clip(-lg / (lh + ridge), low, high)
                    right = np.clip(-(total_g - lg) / (total_h - lh + ridge), low, high)
                    gain = lg**2 / (lh + ridge) + (total_g - lg) ** 2 / (total_h - lh + ridge) - total_g**2 / (total_h + ridge)
                    ok = (count >= min_rows) & (len(rows) - count >= min_rows) & (monotone[f] * (right - left) >= 0)
                    gain = np.where(ok, gain, -np.inf)
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (gain[k], (f, k, left[k], right[k]))
            if best[1] is None:
                score[rows] += value[node]
                continue
            f, k, left, right = best[1]
            feature[node], cut[node], child[node] = f, cuts[f][k], used
            middle, goes = (left + right) / 2, binned[rows, f] <= k
            bound = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}
            lo, hi = bound[int(monotone[f])]
            todo += [(used, rows[goes], level + 1, *lo), (used + 1, rows[~goes], level + 1, *hi)]
            used += 2
    return Forest(*out, base, depth)


@dataclass(frozen=True)
class Isotonic:
    """A non-decreasing step fit, joined by straight lines."""

    x: np.ndarray
    y: np.ndarray

    def __call__(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.x, self.y)


def fit_isotonic(score: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pool adjacent violators on rows sorted by score."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # sum of y, rows, sum of scores
    for s, v in zip(score[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([v, 1, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    sums = np.array(blocks)
    return Isotonic(sums[:, 2] / sums[:, 1], sums[:, 0] / sums[:, 1])
