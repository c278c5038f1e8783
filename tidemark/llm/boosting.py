"""Small gradient-boosted trees for yes-or-no questions, with calibrated answers."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class BoostedTrees:
    """Trees of fixed depth over binned features, fitted to the logistic loss by Newton steps.

    ``fit`` keeps every fourth row out and turns the trees' sum into a probability on those.
    """

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 1.0) -> None:
        self.rounds, self.depth, self.rate, self.bins, self.l2 = rounds, depth, rate, bins, l2
        self.features = np.zeros((0, 2 ** depth - 1), dtype=np.int64)
        self.limits = np.zeros((0, 2 ** depth - 1))
        self.leaves = np.zeros((0, 2 ** depth))
        self.slope, self.shift = 1.0, 0.0

    def _place(self, x: np.ndarray, features: np.ndarray, limits: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[rows, features[at]] > limits[at])
        return at - (2 ** self.depth - 1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for features, limits, leaves in zip(self.features, self.limits, self.leaves):
            total += leaves[self._place(x, features, limits)]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        if len(x) == 0:
            return np.zeros(0)
        return sigmoid(self.slope * self.margin(x) + self.shift)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        held = np.arange(len(x)) % 4 == 3
        self._boost(x[~held], y[~held].astype(float))
        margin, truth = self.margin(x[held]), y[held].astype(float)
        # Platt's targets keep a separable sample from infinite slopes
        yes, no = truth.sum(), (1 - truth).sum()
        target = np.where(truth > 0, (yes + 1) / (yes + 2), 1 / (no + 2))
        weights = np.array([1.0, 0.0])
        design = np.stack([margin, np.ones(len(margin))], axis=1)
        for _ in range(50):
            p = sigmoid(design @ weights)
            hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
            step = np.linalg.solve(hessian, design.T @ (p - target))
            weights -= np.clip(step, -2, 2)
        self.slope, self.shift = float(max(weights[0], 1e-3)), float(weights[1])
        return self

    def _boost(self, x: np.ndarray, y: np.ndarray) -> None:
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        margin = np.zeros(len(x))
        features, limits, leaves = [], [], []
        for _ in range(self.rounds):
            p = sigmoid(margin)
            gradient, hessian = p - y, np.maximum(p * (1 - p), 1e-9)
            at = np.zeros(len(x), dtype=np.int64)
            tree_f = np.zeros(2 ** self.depth - 1, dtype=np.int64)
            tree_l = np.full(2 ** self.depth - 1, np.inf)
            for level in range(self.depth):
                first, nodes = 2 ** level - 1, 2 ** level
                best = np.full(nodes, 1e-6)
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    slot = (at - first) * (self.bins + 1) + binned[:, f]
                    size = nodes * (self.bins + 1)
                    g = np.bincount(slot, gradient, size).reshape(nodes, -1).cumsum(axis=1)
                    h = np.bincount(slot, hessian, size).reshape(nodes, -1).cumsum(axis=1)
                    all_g, all_h = g[:, -1:], h[:, -1:]
                    gain = (g ** 2 / (h + self.l2) + (all_g - g) ** 2 / (all_h - h + self.l2)
                            - all_g ** 2 / (all_h + self.l2))[:, :len(e)]
                    k = gain.argmax(axis=1)
                    for node in np.flatnonzero(gain[np.arange(nodes), k] > best):
                        best[node] = gain[node, k[node]]
                        tree_f[first + node], tree_l[first + node] = f, e[k[node]]
                at = 2 * at + 1 + (x[np.arange(len(x)), tree_f[at]] > tree_l[at])
            leaf = at - (2 ** self.depth - 1)
            size = 2 ** self.depth
            value = -self.rate * np.bincount(leaf, gradient, size) / (np.bincount(leaf, hessian, size) + self.l2)
            margin += value[leaf]
            features.append(tree_f)
            limits.append(tree_l)
            leaves.append(value)
        self.features, self.limits, self.leaves = np.array(features), np.array(limits), np.array(leaves)
