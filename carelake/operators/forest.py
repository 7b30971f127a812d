"""Growing the trees of a random forest on counted cells of its grid.

MLlib's forest first cuts every feature into at most ``maxBins`` bins and from there on looks at bins only: rows
with the same bins and the same label are one to it. Here such rows are counted first (``treatment.tune_forest``), and a
tree is grown on the counts, whatever the number of rows: histograms of the nodes of a level, the best cut
of a random subset of the features per node, children of the nodes with a gain. A bootstrap bag draws Poisson(1) copies
of each row, so Poisson(n) of n rows.

A tree's draws depend on the seed, its number and the level only. So a tree of depth 5 is what a tree of depth 20 is
down to level 5, and a forest of 50 trees is the first 50 of 150: a search over depths and sizes grows each tree once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

HISTOGRAM = 1 << 19  # entries of a histogram at a time: bounds the memory of a level


class Cells(NamedTuple):
    """Rows counted per cell of the features' bins: the cuts between the bins, ``bins`` [feature, cell], all below
    ``width``, and the rows [label, cell] to fit on and to validate with."""
    cuts: list[list[float]]
    bins: np.ndarray
    width: int
    fit: np.ndarray
    check: np.ndarray


def cells(cuts: list[list[float]], number: np.ndarray, fit: np.ndarray, check: np.ndarray) -> Cells:
    """From the numbers of the cells: a digit per feature with cuts, of ``len(cuts) + 2`` values. In their order."""
    by, width = np.argsort(number), max(len(c) for c in cuts) + 1
    rest, bins = number[by], np.zeros((len(cuts), len(number)), np.min_scalar_type(width))
    for f, c in enumerate(cuts):
        if c:
            rest, bins[f] = np.divmod(rest, len(c) + 2)
    return Cells(cuts, bins, width, fit[:, by], check[:, by])


class Tree(NamedTuple):
    """Nodes level by level; the children of a node are ``left`` and ``left + 1``, -1 for none."""
    feature: np.ndarray
    split: np.ndarray  # bins up to this one go left
    gain: np.ndarray
    count: np.ndarray  # [node, label]
    left: np.ndarray
    levels: list[int]  # the first node of each level, and the number of nodes


def _gini(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    n = n0 + n1
    return 1.0 - (n0 / n) ** 2 - (n1 / n) ** 2


def _best_cuts(bins, weight, cells, node, count, tries, width) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cut with the highest gain per node (features and bins in order, the first of equals): feature, last bin that
    goes left, gain. ``cells`` come in the order of their ``node``; ``tries`` [node, feature] tells which features count."""
    k = len(count)
    feature, split, gain = np.full(k, -1, np.int16), np.zeros(k, np.int16), np.zeros(k)
    for a in range(0, k, step := max(1, HISTOGRAM // width)):
        b = min(a + step, k)
        of = slice(*np.searchsorted(node, (a, b)))
        here, at = cells[of], node[of] - a
        for f in range(len(bins)):
            of_f = np.flatnonzero(tries[a:b, f])
            if not len(of_f):
                continue
            place = np.full(b - a, -1)
            place[of_f] = np.arange(len(of_f))
            p = place[at]
            own = p >= 0
            i, c = p[own] * width + bins[f, here[own]], here[own]
            l0, l1 = (np.bincount(i, w[c], len(of_f) * width).reshape(-1, width).cumsum(axis=1)[:, :-1] for w in weight)
            n0, n1 = count[a:b][of_f].T[:, :, None]
            n, l, r0, r1 = n0 + n1, l0 + l1, n0 - l0, n1 - l1
            r = n - l
            with np.errstate(divide="ignore", invalid="ignore"):
                g = _gini(n0, n1) - l / n * _gini(l0, l1) - r / n * _gini(r0, r1)
            g[(l == 0) | (r == 0)] = -1.0
            j = g.argmax(axis=1)
            g = g[np.arange(len(j)), j]
            better = g > gain[a:b][of_f]
            at_f = of_f[better] + a
            feature[at_f], split[at_f], gain[at_f] = f, j[better], g[better]
    return feature, split, gain


def grow(bins: np.ndarray, count: np.ndarray, width: int, depth: int, subset: int, bootstrap: bool, seed: int, number: int) -> Tree:
    """A tree of at most ``depth`` levels below its root. ``bins`` [feature, cell] are below ``width``, ``count`` [label, cell]."""
    rng = np.random.default_rng([seed, number])
    weight = (rng.poisson(count) if bootstrap else count).astype(float)
    cells = np.flatnonzero(weight.sum(axis=0))
    node = np.zeros(len(cells), np.int64)
    n = weight.sum(axis=1)[None, :]
    levels, found = [0], []
    for level in range(depth + 1):
        k = len(n)
        feature, split, gain, left = np.full(k, -1, np.int16), np.zeros(k, np.int16), np.full(k, -1.0), np.full(k, -1, np.int64)
        mixed = np.flatnonzero((n > 0).all(axis=1)) if level < depth else np.zeros(0, np.int64)
        if len(mixed):
            order = np.full(k, -1, np.int64)
            order[mixed] = np.arange(len(mixed))
            node = order[node]
            cells, node = cells[node >= 0], node[node >= 0]
            tries = np.zeros((len(mixed), len(bins)), bool)
            np.put_along_axis(tries, rng.random((len(mixed), len(bins))).argsort(axis=1)[:, :subset], True, axis=1)
            f, s, g = _best_cuts(bins, weight, cells, node, n[mixed], tries, max(width, 2))
            cut = np.flatnonzero(f >= 0)
            at = mixed[cut]
            feature[at], split[at], gain[at], left[at] = f[cut], s[cut], g[cut], levels[-1] + k + 2 * np.arange(len(cut))
            child = np.full(len(mixed), -1, np.int64)
            child[cut] = 2 * np.arange(len(cut))
            live = child[node] >= 0
            cells, node = cells[live], node[live]
            node = child[node] + (bins[f[node], cells] > s[node])
            by_node = np.argsort(node, kind="stable")
            cells, node = cells[by_node], node[by_node]
        found.append((feature, split, gain, n, left))
        levels.append(levels[-1] + k)
        n = np.stack([np.bincount(node, w[cells], 2 * int((left >= 0).sum())) for w in weight], axis=1) if (left >= 0).any() else n[:0]
        if not len(n):
            break
    return Tree(*(np.concatenate(x) for x in zip(*found)), levels)


def leaves(tree: Tree, depth: int) -> np.ndarray:
    """Which nodes are leaves of the tree cut at ``depth``. As in MLlib, two leaves that predict the same become one."""
    leaf, says = tree.left < 0, tree.count[:, 1] > tree.count[:, 0]
    deep = min(depth, len(tree.levels) - 2)
    leaf[tree.levels[deep]:tree.levels[deep + 1]] |= deep == depth
    for level in range(deep - 1, -1, -1):
        at = np.arange(tree.levels[level], tree.levels[level + 1])
        at = at[~leaf[at]]
        l = tree.left[at]
        leaf[at[leaf[l] & leaf[l + 1] & (says[l] == says[l + 1])]] = True
    return leaf


def shares(tree: Tree, bins: np.ndarray, depths: list[int]) -> Iterator[np.ndarray]:
    """For each of ``depths`` (ascending): the share of label 1 in the leaf of each cell, of the tree cut at that depth."""
    at, moving, level = np.zeros(bins.shape[1], np.int64), np.arange(bins.shape[1]), 0
    total = tree.count.sum(axis=1)
    share = np.divide(tree.count[:, 1], total, out=np.zeros(len(total)), where=total > 0)
    for depth in depths:
        while level < depth and len(moving):
            moving = moving[tree.left[at[moving]] >= 0]
            here = at[moving]
            at[moving] = tree.left[here] + (bins[tree.feature[here], moving] > tree.split[here])
            level += 1
        leaf, value = leaves(tree, depth), share.copy()
        for upper in range(min(depth, len(tree.levels) - 2)):  # nodes below a leaf say what it says
            above = np.arange(tree.levels[upper], tree.levels[upper + 1])
            above = above[leaf[above] & (tree.left[above] >= 0)]
            for child in (tree.left[above], tree.left[above] + 1):
                leaf[child], value[child] = True, value[above]
        yield value[at]


def kept(tree: Tree, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nodes of the tree cut at ``depth``: their numbers in ``tree``, whether they are leaves, and each one's new left child."""
    leaf, there = leaves(tree, depth), np.zeros(len(tree.left), bool)
    there[0] = True
    for level in range(min(depth, len(tree.levels) - 2)):
        at = np.arange(tree.levels[level], tree.levels[level + 1])
        l = tree.left[at[there[at] & ~leaf[at]]]
        there[l] = there[l + 1] = True
    nodes, new = np.flatnonzero(there), np.cumsum(there) - 1
    return nodes, leaf[nodes], np.where(leaf[nodes], -1, new[tree.left[nodes]])
