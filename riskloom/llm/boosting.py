"""Gradient-boosted trees for a two-class label, in numpy, for small training sets."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees of one depth; an absent split sends every row left."""

    base: float
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray
    leaf: np.ndarray  # trees x leaves
    slope: float = 1.0  # calibration: probability = sigmoid(slope * margin + offset)
    offset: float = 0.0

    def margin(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.base)
        depth = int(np.log2(self.leaf.shape[1])) if self.leaf.size else 0
        every = np.arange(len(rows))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (rows[every, feature[node]] > threshold[node])
            out += leaf[node - (len(leaf) - 1)]
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * self.margin(rows) + self.offset)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_trees(
    rows: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, ridge: float = 1.0
) -> Trees:
    """Newton boosting of the logistic loss over quantile bins."""
    n, width = rows.shape
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    prior = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(prior / (1 - prior)))
    margin = np.full(n, base)
    inner, leaves = 2**depth - 1, 2**depth
    out = Trees(base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)))
    for t in range(trees):
        chance = sigmoid(margin)
        grad, hess = labels - chance, chance * (1 - chance)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            for at in range(2**level - 1, 2 ** (level + 1) - 1):
                own = np.flatnonzero(node == at)
                if len(own):
                    split = _best_split(binned[own], grad[own], hess[own], bins, ridge)
                    if split and split[1] < len(edges[split[0]]):
                        out.feature[t, at], out.threshold[t, at] = split[0], edges[split[0]][split[1]]
                node[own] = 2 * at + 1 + (rows[own, out.feature[t, at]] > out.threshold[t, at])
        leaf = node - inner
        g, h = (np.bincount(leaf, w, leaves) for w in (grad, hess))
        out.leaf[t] = rate * g / (h + ridge)
        margin += out.leaf[t][leaf]
    return out


def _best_split(binned, grad, hess, bins, ridge):
    """(feature, bin): rows of that bin and below go left; None if nothing is gained."""
    g_all, h_all = grad.sum(), hess.sum()
    best, found = 1e-6, None
    for f in range(binned.shape[1]):
        g = np.cumsum(np.bincount(binned[:, f], grad, bins))[:-1]
        h = np.cumsum(np.bincount(binned[:, f], hess, bins))[:-1]
        gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
        at = int(np.argmax(gain))
        if gain[at] > best:
            best, found = gain[at], (f, at)
    return found


def calibrate(model: Trees, rows: np.ndarray, labels: np.ndarray, steps: int = 50) -> None:
    """Platt scaling on rows the trees have not seen, with smoothed targets."""
    margin, up, down = model.margin(rows), labels.sum(), len(labels) - labels.sum()
    target = np.where(labels > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        chance = sigmoid(a * margin + b)
        weight = np.maximum(chance * (1 - chance), 1e-9)
        gradient = np.array([((target - chance) * margin).sum(), (target - chance).sum()])
        cross = (weight * margin).sum()
        hessian = np.array([[(weight * margin**2).sum() + 1e-3, cross], [cross, weight.sum() + 1e-3]])
        step = np.linalg.solve(hessian, gradient)
        a, b = a + np.clip(step[0], -0.5, 0.5), b + np.clip(step[1], -2, 2)
    model.slope, model.offset = max(float(a), 1e-3), float(b)
