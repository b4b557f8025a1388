"""Shallow regression trees on binned features, and what is boosted from them. Fits on bounded samples, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Quantile cuts of each column; a column with few values is cut between them."""
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) <= bins:
            out.append((values[1:] + values[:-1]) / 2)
        else:
            out.append(np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])))
    return out


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, c, "right") for e, c in zip(edges, x.T, strict=True)], 1).astype(np.int16)


@dataclass
class Tree:
    """A full tree: node k has children 2k + 1 and 2k + 2; a row goes left where its bin is at most the cut."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    depth: int

    def leaves(self, b: np.ndarray) -> np.ndarray:
        at = np.zeros(len(b), np.int64)
        rows = np.arange(len(b))
        for _ in range(self.depth):
            at = 2 * at + 1 + (b[rows, self.feature[at]] > self.cut[at])
        return at - (len(self.feature))

    def predict(self, b: np.ndarray) -> np.ndarray:
        return self.value[self.leaves(b)]


def fit_tree(b: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, features, depth: int, bins: int, least: float = 5.0, ridge: float = 1.0) -> Tree:
    """Greedy splits by second-order gain; a node that gains nothing keeps one value on both sides."""
    inner = 2**depth - 1
    feature, cut = np.full(inner, features[0], np.int64), np.full(inner, bins, np.int64)
    at = np.zeros(len(b), np.int64)
    for level in range(depth):
        base, width = 2**level - 1, 2**level
        node = at - base
        gain = np.full(width, 1e-9)
        for f in features:
            slot = node * bins + b[:, f]
            g = np.bincount(slot, gradient, width * bins).reshape(width, bins).cumsum(1)
            h = np.bincount(slot, hessian, width * bins).reshape(width, bins).cumsum(1)
            gl, hl, gt, ht = g[:, :-1], h[:, :-1], g[:, -1:], h[:, -1:]
            score = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            score[(hl < least) | (ht - hl < least)] = 0
            best = score.argmax(1)
            top = score[np.arange(width), best]
            better = top > gain
            gain[better] = top[better]
            feature[base : base + width][better] = f
            cut[base : base + width][better] = best[better]
        at = 2 * at + 1 + (b[np.arange(len(b)), feature[at]] > cut[at])
    leaf = at - inner
    g, h = np.bincount(leaf, gradient, inner + 1), np.bincount(leaf, hessian, inner + 1)
    return Tree(feature, cut, -g / (h + ridge), depth)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Boosted:
    """Gradient-boosted trees for two classes; the score is a logit."""

    edges: list[np.ndarray]
    start: float
    trees: list[Tree]

    def logit(self, x: np.ndarray) -> np.ndarray:
        b = binned(x, self.edges)
        out = np.full(len(b), self.start)
        for tree in self.trees:
            out += tree.predict(b)
        return out


def fit_boosted(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 32, rate: float = 0.2) -> Boosted:
    edges = bin_edges(x, bins)
    b = binned(x, edges)
    p = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
    model = Boosted(edges, float(np.log(p / (1 - p))), [])
    if not len(y):
        return model
    at = np.full(len(y), model.start)
    for _ in range(trees):
        q = sigmoid(at)
        tree = fit_tree(b, q - y, q * (1 - q), range(x.shape[1]), depth, bins + 1, least=1.0)
        tree.value *= rate
        at += tree.predict(b)
        model.trees.append(tree)
    return model
