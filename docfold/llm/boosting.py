"""Boosted regression trees on binned features, and isotonic calibration: small helpers in numpy.

Both are fitted on a bounded sample and applied to batches inside tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Trees:
    """Full binary trees of equal depth: per tree the split features, thresholds and leaf values."""

    start: float
    features: np.ndarray
    thresholds: np.ndarray
    leaves: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        depth = int(np.log2(self.leaves.shape[1])) if len(self.leaves) else 0
        for features, thresholds, leaves in zip(
            self.features, self.thresholds, self.leaves, strict=True
        ):
            node = np.zeros(len(x), int)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, features[node]] > thresholds[node])
            out += leaves[node - (len(leaves) - 1)]
        return out


def boost(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    penalty: float = 1.0,
) -> Trees:
    """Gradient boosting for the logistic loss, with Newton steps in the leaves."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    start, d = float(np.log(share / (1 - share))), x.shape[1]
    inner, last = 2**depth - 1, 2**depth
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, j], quantiles)) for j in range(d)] if len(x) else []
    binned = np.column_stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)]) if len(x) else x
    all_features, all_thresholds, all_leaves = [], [], []
    margin = np.full(len(y), start)
    for _ in range(trees if len(x) else 0):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = y - p, p * (1 - p)
        features = np.zeros(inner, int)
        thresholds = np.full(inner, np.inf)
        node = np.zeros(len(y), int)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            local, best = node - first, np.full(width, 1e-9)
            for j in range(d):
                cells = local * BINS + binned[:, j]
                g = np.bincount(cells, gradient, width * BINS).reshape(width, BINS)
                h = np.bincount(cells, weight, width * BINS).reshape(width, BINS)
                left_g, left_h = g.cumsum(axis=1)[:, :-1], h.cumsum(axis=1)[:, :-1]
                all_g, all_h = g.sum(axis=1)[:, None], h.sum(axis=1)[:, None]
                right_g, right_h = all_g - left_g, all_h - left_h
                gain = (
                    left_g**2 / (left_h + penalty)
                    + right_g**2 / (right_h + penalty)
                    - all_g**2 / (all_h + penalty)
                )[:, : len(edges[j])]
                if not gain.size:
                    continue
                at = gain.argmax(axis=1)
                for k in np.flatnonzero(gain.max(axis=1) > best):
                    best[k] = gain[k, at[k]]
                    features[first + k], thresholds[first + k] = j, edges[j][at[k]]
            right = x[np.arange(len(y)), features[node]] > thresholds[node]
            node = 2 * node + 1 + right
        leaf = node - inner
        total = np.bincount(leaf, gradient, last) / (np.bincount(leaf, weight, last) + penalty)
        margin += rate * total[leaf]
        all_features.append(features)
        all_thresholds.append(thresholds)
        all_leaves.append(rate * total)
    return Trees(
        start,
        np.array(all_features, int).reshape(-1, inner),
        np.array(all_thresholds, float).reshape(-1, inner),
        np.array(all_leaves, float).reshape(-1, last),
    )


@dataclass
class Isotonic:
    """A rising line through the centres of pooled blocks."""

    margins: np.ndarray
    shares: np.ndarray

    def apply(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.margins, self.shares)


def calibrate(margin: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pool adjacent violators; without rows, the logistic curve."""
    if not len(margin):
        grid = np.linspace(-8, 8, 65)
        return Isotonic(grid, 1 / (1 + np.exp(-grid)))
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # weight, mean label, mean margin
    for m, label in zip(margin[order], y[order], strict=True):
        blocks.append([1.0, float(label), float(m)])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w, share, centre = blocks.pop()
            v = blocks[-1]
            total = v[0] + w
            blocks[-1] = [total, (v[0] * v[1] + w * share) / total, (v[0] * v[2] + w * centre) / total]
    # One row's weight of doubt on both sides keeps the ends off 0 and 1.
    shares = np.array([(w * s + 0.5) / (w + 1) for w, s, _ in blocks])
    return Isotonic(np.array([b[2] for b in blocks]), np.maximum.accumulate(shares))
