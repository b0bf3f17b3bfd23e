"""Decision trees of few samples and some hundred features in numpy, so that a section's forests grow inside one task.

A tree splits where the sum of squared sums over counts gains most: with one column of y a class that is Gini's impurity, with one
column of numbers their variance. All cuts between neighbouring values of a feature are tried.
"""

from __future__ import annotations

import numpy as np


class Tree:
    """Nodes as lists: feature (-1: leaf), cut (at most it: left), left, right, value (mean of y); gains by feature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rows: np.ndarray, depth: int, width: int, rng: np.random.Generator):
        self.feature, self.cut, self.left, self.right, self.value = [], [], [], [], []
        self.gains = np.zeros(x.shape[1])
        waiting = [(self._node(y[rows]), rows, 0)]
        while waiting:
            at, here, level = waiting.pop()
            found = self._split(x, y[here], here, width, rng) if level < depth else None
            if found is None:
                continue
            f, cut, gain = found
            low = x[here, f] <= cut
            self.gains[f] += gain
            self.feature[at], self.cut[at] = f, cut
            for side, part in ((self.left, here[low]), (self.right, here[~low])):
                side[at] = self._node(y[part])
                waiting.append((side[at], part, level + 1))
        self.feature, self.cut, self.left, self.right, self.value = map(np.array, (self.feature, self.cut, self.left, self.right, self.value))

    def _node(self, y: np.ndarray) -> int:
        for of, v in ((self.feature, -1), (self.cut, 0.0), (self.left, 0), (self.right, 0), (self.value, y.mean(0))):
            of.append(v)
        return len(self.feature) - 1

    @staticmethod
    def _split(x, y, here, width, rng):
        """(feature, cut, gain) of the best cut of `width` features drawn; more are drawn while none of them varies."""
        n, d = len(here), x.shape[1]
        if n < 2 or (y == y[0]).all():
            return None
        order = rng.permutation(d) if width < d else np.arange(d)
        total = y.sum(0)
        k = np.arange(1, n)[:, None]
        for start in range(0, d, width):
            some = order[start : start + width]
            v = x[here[:, None], some]
            by = v.argsort(0, kind="stable")
            v = np.take_along_axis(v, by, 0)
            differ = v[1:] > v[:-1]
            if not differ.any():
                continue
            low = y[by].cumsum(0)[:-1]
            worth = np.where(differ, (low * low).sum(2) / k + ((total - low) ** 2).sum(2) / (n - k), -np.inf)
            i, j = divmod(int(worth.argmax()), len(some))
            cut = v[i, j] + (v[i + 1, j] - v[i, j]) / 2
            return int(some[j]), cut if cut < v[i + 1, j] else v[i, j], max(0.0, float(worth[i, j] - (total * total).sum() / n))
        return None

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        at, rows = np.zeros(len(x), int), np.arange(len(x))
        while (inner := self.feature[at] >= 0).any():
            at = np.where(inner, np.where(x[rows, self.feature[at]] <= self.cut[at], self.left[at], self.right[at]), at)
        return at


def forest(x: np.ndarray, y: np.ndarray, classes: int, trees: int, depth: int, seed: int) -> list[Tree]:
    """Trees on samples drawn with replacement, the root of the number of features tried at each node. y: classes from 0."""
    rng, one = np.random.default_rng(seed), np.eye(classes)[y]
    width = max(1, int(np.sqrt(x.shape[1])))
    return [Tree(x, one, rng.integers(0, len(x), len(x)), depth, width, rng) for _ in range(trees)]


def voted(trees: list[Tree], x: np.ndarray) -> np.ndarray:
    """The class of the largest mean share in the leaves, the first of equal ones."""
    share = sum(t.value[t.leaves(x)] for t in trees) / len(trees)
    return np.round(share, 12).argmax(1)


def importances(trees: list[Tree]) -> np.ndarray:
    """Shares of the features in the gains of each tree, averaged over the trees that split, 1 in all (0 without a split)."""
    mean, split = np.zeros(len(trees[0].gains)), 0
    for t in trees:  # one by one: features may be many
        if (whole := t.gains.sum()) > 0:
            mean += t.gains / whole
            split += 1
    mean /= split or 1
    return mean / (mean.sum() or 1.0)


def boosted(x: np.ndarray, y: np.ndarray, q: np.ndarray, rounds: int, depth: int = 5, step: float = 0.1) -> np.ndarray:
    """Classes (0 or 1) of q by trees on what the logistic loss leaves, each leaf a Newton step."""
    p = y.mean()
    base = np.log(p / (1 - p))
    fitted, asked = np.full(len(x), base), np.full(len(q), base)
    rng = np.random.default_rng(0)  # not drawn from: every feature is tried
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-fitted))
        tree = Tree(x, (y - p)[:, None], np.arange(len(x)), depth, x.shape[1], rng)
        at = tree.leaves(x)
        rest, bend = (np.bincount(at, w, len(tree.feature)) for w in (y - p, p * (1 - p)))
        leaf = step * np.divide(rest, bend, out=np.zeros_like(rest), where=bend > 1e-150)
        fitted, asked = fitted + leaf[at], asked + leaf[tree.leaves(q)]
    return (asked > 0).astype(int)
