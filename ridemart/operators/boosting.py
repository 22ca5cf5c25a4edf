"""Gradient boosting of regression trees on histograms, for one bounded series (T5).

Squared loss, L2 on the leaf values, a learned side for missing values, best
split first up to a number of leaves.  For a node with gradient sum G and N
rows (the hessian of squared loss is 1 a row) the leaf value is
``-rate * G / (N + l2)`` and a cut scores
``GL^2 / (NL + l2) + GR^2 / (NR + l2)``; it must score more than
``G^2 / (N + l2)``.

``boost`` is called by Spark once per (fleet, fold), each a group of at most
the window's hours; see ``ridemart.operators.forecast``.
"""

from __future__ import annotations

import heapq
import sys
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle

# Runs in Python workers: shipped by value, so they need no package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Scores closer than this (relative) are equal, so that rounding decides no tie.
TIE = 1e-9


@dataclass(frozen=True)
class BoostingConfig:
    trees: int = 500
    rate: float = 0.06
    depth: int = 7
    leaves: int = 31
    bins: int = 255
    min_leaf: int = 20
    l2: float = 1.0


def bin_edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Cuts between bins: midpoints of distinct values, or of quantiles where there are more than ``bins``.

    A value belongs to the first bin whose edge is not below it.
    """
    distinct = np.unique(values[~np.isnan(values)])
    if len(distinct) > bins:
        known = np.sort(values[~np.isnan(values)])
        at = np.arange(1, bins) * len(known) // bins
        return np.unique((known[at - 1] + known[at]) / 2)
    return (distinct[:-1] + distinct[1:]) / 2


class Histograms:
    """Binned features of all rows; the cells of all features lie in one flat range, missing values after them."""

    def __init__(self, x: np.ndarray, train: np.ndarray, bins: int):
        edges = [bin_edges(x[train, f], bins) for f in range(x.shape[1])]
        sizes = np.array([len(e) + 1 for e in edges])
        self.first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.cells = int(sizes.sum())
        self.feature = np.repeat(np.arange(len(sizes)), sizes)
        missing = np.isnan(x)
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1) + self.first
        self.codes = np.where(missing, self.cells + np.arange(x.shape[1]), binned)

    def sums(self, rows: np.ndarray, gradient: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Gradient sums and row counts left of every cut (missing values not in), and of the missing values."""
        flat, n = self.codes[rows].ravel(), self.cells + len(self.first)
        g = np.bincount(flat, np.repeat(gradient[rows], len(self.first)), n)
        c = np.bincount(flat, minlength=n).astype(float)
        left = []
        for h in (g, c):
            run = np.cumsum(h[:self.cells])
            before = np.concatenate([[0.0], run])[self.first]
            left.append(run - before[self.feature])
        return left[0], left[1], g[self.cells:][self.feature], c[self.cells:][self.feature]

    def goes_left(self, rows: np.ndarray, cut: int, missing_left: bool) -> np.ndarray:
        codes = self.codes[rows, self.feature[cut]]
        return np.where(codes >= self.cells, missing_left, codes <= cut)


def best_cut(h: Histograms, rows: np.ndarray, gradient: np.ndarray, cfg: BoostingConfig) -> tuple[float, int, bool] | None:
    """(gain, cut, missing values left) of a node; ties: missing right before left, then feature and bin order."""
    total, n = gradient[rows].sum(), len(rows)
    if n < 2 * cfg.min_leaf:
        return None
    gl, nl, gm, nm = h.sums(rows, gradient)
    sides = [(gl, nl)] + ([(gl + gm, nl + nm)] if nm.any() else [])
    gl, nl = np.concatenate([s[0] for s in sides]), np.concatenate([s[1] for s in sides])
    allowed = (nl >= cfg.min_leaf) & (n - nl >= cfg.min_leaf)
    score = np.where(allowed, gl * gl / (nl + cfg.l2) + (total - gl) ** 2 / (n - nl + cfg.l2), -1.0)
    most = score.max()
    parent = total * total / (n + cfg.l2)
    if most <= parent * (1 + TIE):
        return None
    at = int(np.argmax(score >= most * (1 - TIE)))
    return float(most - parent), at % h.cells, at >= h.cells


def grow(h: Histograms, train: np.ndarray, gradient: np.ndarray, cfg: BoostingConfig) -> np.ndarray:
    """The step that one tree adds to every row."""
    step = np.zeros(len(train))
    heap: list[tuple] = []
    made = 0

    def offer(everyone: np.ndarray, depth: int) -> None:
        nonlocal made
        rows = everyone[train[everyone]]
        step[everyone] = -cfg.rate * gradient[rows].sum() / (len(rows) + cfg.l2)
        found = best_cut(h, rows, gradient, cfg) if depth < cfg.depth else None
        if found:
            heapq.heappush(heap, (-float(f"{found[0]:.9e}"), made, everyone, depth, found[1:]))
        made += 1

    offer(np.arange(len(train)), 0)
    leaves = 1
    while heap and leaves < cfg.leaves:
        _, _, everyone, depth, (cut, missing_left) = heapq.heappop(heap)
        left = h.goes_left(everyone, cut, missing_left)
        offer(everyone[left], depth + 1)
        offer(everyone[~left], depth + 1)
        leaves += 1
    return step


def boost(x: np.ndarray, y: np.ndarray, train: np.ndarray, cfg: BoostingConfig) -> np.ndarray:
    """Predictions for all rows of a model fitted on those marked ``train``."""
    h = Histograms(x, train, cfg.bins)
    pred = np.full(len(y), y[train].mean())
    for _ in range(cfg.trees):
        pred += grow(h, train, pred - y, cfg)
    return pred
