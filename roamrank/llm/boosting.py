"""Gradient-boosted trees on small, bounded training sets, and their calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees of one depth: split feature and value by node, value by leaf."""

    bias: float
    feature: np.ndarray  # trees × nodes
    value: np.ndarray
    leaf: np.ndarray  # trees × leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.bias)
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, value, leaf in zip(self.feature, self.value, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > value[node])
            total += leaf[node - (len(leaf) - 1)]
        return total


def fit(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, l2: float = 1.0) -> Trees:
    """Second-order boosting of log loss, split at quantiles of each feature."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 17)[1:-1], method="lower")) for j in range(x.shape[1])]
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Trees(
        float(np.log(mean / (1 - mean))),
        np.zeros((trees, 2**depth - 1), dtype=np.int64),
        np.full((trees, 2**depth - 1), np.inf),
        np.zeros((trees, 2**depth)),
    )
    margin = np.full(len(x), model.bias)
    above = [x[:, [j]] > cuts[j][None, :] for j in range(x.shape[1])]
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(x), dtype=np.int64)
        for k in range(2**depth - 1):
            here = node == k
            g, h = grad[here], hess[here]
            best, g_all, h_all = 1e-6, g.sum(), h.sum()
            for j, split in enumerate(above):
                right = split[here]
                g_r, h_r = g @ right, h @ right
                gain = g_r**2 / (h_r + l2) + (g_all - g_r) ** 2 / (h_all - h_r + l2) - g_all**2 / (h_all + l2)
                i = int(np.argmax(gain)) if gain.size else -1
                if i >= 0 and gain[i] > best:
                    best, model.feature[t, k], model.value[t, k] = gain[i], j, cuts[j][i]
            node[here] = 2 * k + 1 + (x[here, model.feature[t, k]] > model.value[t, k])
        leaves = node - (2**depth - 1)
        g = np.bincount(leaves, grad, 2**depth)
        h = np.bincount(leaves, hess, 2**depth)
        model.leaf[t] = -rate * g / (h + l2)
        margin += model.leaf[t][leaves]
    return model


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn margins into probabilities, by Newton steps on held-out rows."""
    a, b = 1.0, 0.0
    # Smoothed targets keep the slope finite where the classes are separable.
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    x = np.column_stack([margin, np.ones(len(y))])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * w[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - target))
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
    return max(a, 1e-3), b


def threshold(probability: np.ndarray, y: np.ndarray, precision: float, least: float = 0.5) -> float:
    """The smallest cut, ``least`` or more, at which the held-out rows kept reach ``precision``."""
    order = np.argsort(-probability, kind="stable")
    p, hits = probability[order], np.cumsum(y[order])
    good = np.flatnonzero((hits / np.arange(1, len(p) + 1) >= precision) & (p >= least))
    return float(p[good[-1]]) if good.size else 1.1
