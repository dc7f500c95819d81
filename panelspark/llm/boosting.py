"""Histogram gradient-boosted trees for a yes/no label, fitted on a bounded sample and flattened into arrays.

Fitting runs on the driver over at most as many rows as the caller's documented bound. Feature values are binned once by
quantiles; each split is found from the bins' sums of gradients and Hessians; rows take logistic loss. A feature may be
held monotone: no split against its direction, and the values below a split stay on their side of its middle.

Scoring walks all trees of a block of rows at once: node numbers are looked up in flat arrays, level by level.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 64
TREES = 60
DEPTH = 4
RATE = 0.15
#: Added to the Hessian sum of a leaf, and least Hessian sum that a leaf needs.
RIDGE = 1.0
LEAST_HESSIAN = 1.0


@dataclass
class Trees:
    """All trees in flat arrays; a leaf points to itself, so a walk of ``depth`` steps ends in one."""

    prior: float
    depth: int = 0
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of a yes for each row of ``x``; values of a threshold or less go left."""
        total = np.full(len(x), self.prior)
        if len(self.roots) and len(x):
            node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
            rows = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total = total + self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, monotone: dict[int, int] | None = None, trees: int = TREES, depth: int = DEPTH):
    """Trees for features ``x`` (rows by features) and labels ``y`` (0 or 1).

    ``monotone`` maps a feature to +1 (the score may only rise with it) or -1. No rows give a score of 0.5, labels of
    one kind the smoothed share of that kind.
    """
    yes, n = float(y.sum()), len(y)
    prior = float(np.log((yes + 1) / (n - yes + 1)))
    if yes in (0, n):
        return Trees(prior)
    edges = [np.unique(np.quantile(column, np.arange(1, BINS) / BINS, method="lower")) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], axis=1)
    direction = np.zeros(x.shape[1], int)
    for k, sign in (monotone or {}).items():
        direction[k] = sign
    nodes: list[list] = []  # feature, threshold, left, right, value
    roots = []
    total = np.full(n, prior)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        roots.append(len(nodes))
        _grow(nodes, np.arange(n), depth, binned, p - y, p * (1 - p), edges, direction, -np.inf, np.inf, total)
    columns = [np.array(c) for c in zip(*nodes)]
    kinds = (np.int32, np.float64, np.int32, np.int32, np.float64)
    feature, threshold, left, right, value = (c.astype(k) for c, k in zip(columns, kinds))
    return Trees(prior, depth, np.array(roots, np.int32), feature, threshold, left, right, value)


def _leaf(g: float, h: float, low: float, high: float) -> float:
    return float(np.clip(-g / (h + RIDGE), low, high))


def _grow(nodes, rows, depth, binned, g, h, edges, direction, low, high, total) -> int:
    """Adds the node of ``rows`` and what lies below; adds the leaves' values to ``total``."""
    at = len(nodes)
    nodes.append([0, 0.0, at, at, 0.0])
    best = _split(binned[rows], g[rows], h[rows], edges, direction, low, high) if depth else None
    if best is None:
        nodes[at][4] = value = RATE * _leaf(g[rows].sum(), h[rows].sum(), low, high)
        total[rows] += value
        return at
    k, cut, left_value, right_value = best
    goes = binned[rows, k] <= cut
    bounds = [(low, high), (low, high)]
    if direction[k]:
        mid = (left_value + right_value) / 2
        bounds = [(low, mid), (mid, high)] if direction[k] > 0 else [(mid, high), (low, mid)]
    nodes[at][0], nodes[at][1] = k, edges[k][cut]
    for place, part, (a, z) in ((2, rows[goes], bounds[0]), (3, rows[~goes], bounds[1])):
        nodes[at][place] = _grow(nodes, part, depth - 1, binned, g, h, edges, direction, a, z, total)
    return at


def _split(binned, g, h, edges, direction, low, high):
    """(feature, last bin of the left side, left and right values) of the largest gain, or None."""
    g_all, h_all = g.sum(), h.sum()

    def gain(gs, hs):
        value = np.clip(-gs / (hs + RIDGE), low, high)
        return -(gs * value + (hs + RIDGE) * value * value / 2), value

    base = gain(g_all, h_all)[0]
    best, found = 1e-9, None
    for k, cuts in enumerate(edges):
        n = len(cuts)
        if not n:
            continue
        gl = np.bincount(binned[:, k], g, n + 1).cumsum()[:n]
        hl = np.bincount(binned[:, k], h, n + 1).cumsum()[:n]
        gain_left, left = gain(gl, hl)
        gain_right, right = gain(g_all - gl, h_all - hl)
        rise = gain_left + gain_right - base
        rise[(hl < LEAST_HESSIAN) | (h_all - hl < LEAST_HESSIAN)] = 0
        if direction[k]:
            rise[direction[k] * (right - left) < 0] = 0
        cut = int(rise.argmax())
        if rise[cut] > best:
            best, found = rise[cut], (k, cut, left[cut], right[cut])
    return found
