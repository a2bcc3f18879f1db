"""Gradient-boosted trees with monotone constraints, flattened into node arrays for scoring many rows at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """All nodes of all trees side by side. A leaf leads to itself on both sides, so every walk has the same length."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds per row: all rows go down all trees together, one level at a time."""
        if not len(self.roots) or not len(x):
            return np.full(len(x), self.base)
        at = np.tile(self.roots, (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            goes_left = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(goes_left, self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -500, 500)))


class _Grower:
    """Grows one forest; rows are binned once, and splits are found on histograms of the bins."""

    def __init__(self, x, signs, depth, bins, l2, least):
        self.signs, self.depth, self.l2, self.least = signs, depth, l2, least
        self.cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        self.binned = [np.searchsorted(cuts, c, "left") for cuts, c in zip(self.cuts, x.T)]
        self.nodes: list[list] = []

    def weight(self, g, h, low, high):
        return np.clip(-g / (h + self.l2), low, high)

    def loss(self, g, h, w):
        return g * w + 0.5 * (h + self.l2) * w * w

    def split(self, rows, g, h, low, high):
        """The best (gain, feature, cut number, left weight, right weight) that keeps the direction of its feature."""
        total_g, total_h = g[rows].sum(), h[rows].sum()
        own = self.loss(total_g, total_h, self.weight(total_g, total_h, low, high))
        best = None
        for f, cuts in enumerate(self.cuts):
            if not len(cuts):
                continue
            bins, size = self.binned[f][rows], len(cuts) + 1
            left_g, left_h, left_n = (
                np.cumsum(np.bincount(bins, weights=w, minlength=size))[:-1]
                for w in (g[rows], h[rows], np.ones(len(rows)))
            )
            w_left = self.weight(left_g, left_h, low, high)
            w_right = self.weight(total_g - left_g, total_h - left_h, low, high)
            gain = own - self.loss(left_g, left_h, w_left) - self.loss(total_g - left_g, total_h - left_h, w_right)
            allowed = (left_n >= self.least) & (len(rows) - left_n >= self.least)
            allowed &= self.signs[f] * (w_right - w_left) >= 0
            gain = np.where(allowed, gain, -np.inf)
            cut = int(gain.argmax())
            if gain[cut] > 1e-6 and (best is None or gain[cut] > best[0]):
                best = (gain[cut], f, cut, w_left[cut], w_right[cut])
        return best

    def grow(self, rows, g, h, rate, low=-np.inf, high=np.inf, level=0) -> int:
        """Add a subtree and return its root. The two sides of a constrained split are kept apart by their middle."""
        at = len(self.nodes)
        weight = float(self.weight(g[rows].sum(), h[rows].sum(), low, high))
        self.nodes.append([0, np.inf, at, at, rate * weight])
        found = self.split(rows, g, h, low, high) if level < self.depth else None
        if found:
            _, f, cut, w_left, w_right = found
            middle = (w_left + w_right) / 2
            bounds = {0: [(low, high), (low, high)], 1: [(low, middle), (middle, high)], -1: [(middle, high), (low, middle)]}
            goes_left = self.binned[f][rows] <= cut
            sides = [
                self.grow(rows[pick], g, h, rate, *bound, level + 1)
                for pick, bound in zip((goes_left, ~goes_left), bounds[self.signs[f]])
            ]
            self.nodes[at] = [f, float(self.cuts[f][cut]), *sides, 0.0]
        return at


def fit_forest(
    x: np.ndarray, y: np.ndarray, signs: Sequence[int], rounds: int = 40, depth: int = 3, rate: float = 0.3,
    bins: int = 64, l2: float = 1.0, least: int = 5,
) -> Forest:
    """Fit log-odds of y (0 or 1). A sign of 1 lets the score only rise with the feature, -1 only fall, 0 leaves it free.

    Without rows, or with one class only, the forest has no trees and says what the rows say (good, if there are none).
    """
    share = float(y.mean()) if len(y) else 1.0
    base = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    empty = np.empty(0, np.int64)
    if not 0 < share < 1:
        return Forest(empty, empty, np.empty(0), empty, empty, np.empty(0), 0, base)
    grower, roots = _Grower(x, list(signs), depth, bins, l2, least), []
    forest = None
    margin = np.full(len(y), base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        roots.append(grower.grow(np.arange(len(y)), p - y, p * (1 - p), rate))
        f, t, left, right, value = zip(*grower.nodes)
        forest = Forest(
            np.array(roots), np.array(f), np.array(t), np.array(left), np.array(right), np.array(value), depth, base
        )
        margin += Forest(np.array(roots[-1:]), *(getattr(forest, n) for n in ("feature", "threshold", "left", "right", "value")), depth, 0.0).margin(x)
    return forest
