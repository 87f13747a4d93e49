"""Gradient-boosted trees for yes-or-no labels, fitted on the histograms of binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES, DEPTH, RATE, BINS, LEAST_WEIGHT, RIDGE = 60, 5, 0.25, 32, 3.0, 1.0


@dataclass
class Trees:
    base: float
    feature: np.ndarray  # of each tree and inner node, nodes in level order
    limit: np.ndarray  # rows with more than this go right
    value: np.ndarray  # of each tree and leaf

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of yes for each row."""
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        depth = int(np.log2(self.value.shape[1]))
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (rows[every, feature[node]] > limit[node])
            total += value[node - (2 ** depth - 1)]
        return total


def fit_trees(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Boost TREES full trees of DEPTH levels on the logistic loss; a node without a gain keeps all rows left."""
    n, width = rows.shape
    edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)]).astype(np.int64)
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score = np.full(n, base)
    features, limits, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = labels - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, limit = np.zeros(2 ** DEPTH - 1, np.int64), np.full(2 ** DEPTH - 1, np.inf)
        for level in range(DEPTH):
            count, first = 2 ** level, 2 ** level - 1
            best = np.full(count, 1e-6)
            choice, cut = np.zeros(count, np.int64), np.full(count, BINS)
            for f in range(width):
                if not len(edges[f]):
                    continue
                at = node * BINS + binned[f]
                g = np.bincount(at, gradient, count * BINS).reshape(count, BINS).cumsum(axis=1)
                h = np.bincount(at, weight, count * BINS).reshape(count, BINS).cumsum(axis=1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = (g ** 2 / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all ** 2 / (h_all + RIDGE))
                gain[(h < LEAST_WEIGHT) | (h_all - h < LEAST_WEIGHT)] = 0
                gain = gain[:, :len(edges[f])]
                k = gain.argmax(axis=1)
                better = gain[np.arange(count), k] > best
                best[better] = gain[better, k[better]]
                choice[better], cut[better] = f, k[better]
            split = cut < BINS
            feature[first:first + count] = choice
            limit[first:first + count] = [edges[f][k] if s else np.inf for f, k, s in zip(choice, cut, split)]
            right = split[node] & (binned[choice[node], np.arange(n)] > cut[node])
            node = 2 * node + right
        g = np.bincount(node, gradient, 2 ** DEPTH)
        h = np.bincount(node, weight, 2 ** DEPTH)
        value = RATE * g / (h + RIDGE)
        score += value[node]
        features.append(feature)
        limits.append(limit)
        values.append(value)
    return Trees(base, np.stack(features), np.stack(limits), np.stack(values))
