"""Random forests for several 0/1 labels of the same sparse rows.

The trees are those of Spark's ``RandomForestClassifier``: rows drawn with replacement (a Poisson weight a row and
tree), as many features a node as the root of their number, Gini gain over binned features, sibling leaves of one
class merged. What differs is the cost of a level:

* as in ``boosting``, a pass costs the entries outside the bin of 0 of the features that a tree's nodes drew,
  not rows x trees x drawn features, and nothing is kept per row and tree;
* one job serves a level of all trees of all labels;
* bins come from the values of all rows, not from a sample of 10 000.

A row's weights are computed from its number and the tree's whenever they are needed. Sums are added and splits
chosen on the executors; splits and importances reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Bins, Tree, binned, find_bins, sparse_blocks

#: Deeper trees are left to Spark's own: a level's nodes are counted side by side.
MOST_DEPTH = 8
#: Sums (node, column) that one pass adds; the trees of a level are dealt to as many passes as that takes.
CELLS = 4 << 20

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
#: Poisson(1) weights of the 65 536 values of 16 random bits, 0 to 8.
POISSON = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)]),
                          (np.arange(65536) + 0.5) / 65536, side="right").astype(np.intp)
#: Weight, and weight of class 1, of a row by its place among a node's: twice its weight, and 1 more in class 1.
PLACES = np.array([(w, w * y) for w in range(POISSON.max() + 1) for y in (0, 1)], dtype=np.float64)


def _mixed(z: np.ndarray) -> np.ndarray:
    """Independent-looking 64 bits of each number (splitmix64)."""
    z = (z ^ (z >> np.uint64(30))) * _M1
    z = (z ^ (z >> np.uint64(27))) * _M2
    return z ^ (z >> np.uint64(31))


def bootstrap_weights(ids: np.ndarray, four: int, seed: int) -> np.ndarray:
    """(4, rows): how often each row, by its number, is drawn for the trees ``4 * four`` and the three after it."""
    base = _mixed(ids.astype(np.uint64) * _STEP + np.uint64(seed & 0xFFFFFFFFFFFFFFFF))
    bits = _mixed(base + np.array([four + 1], dtype=np.uint64) * _STEP)
    return POISSON[bits.view(np.uint16).reshape(-1, 4).T]


def drawn_features(seed: int, tree: int, node: int, n_features: int, n_drawn: int) -> np.ndarray:
    """The features, sorted, that a node looks at."""
    if n_drawn >= n_features:
        return np.arange(n_features)
    return np.sort(np.random.default_rng((seed & 0xFFFFFFFF, tree, node)).choice(n_features, n_drawn, replace=False))


@dataclass
class _Grown:
    """A tree in the making: ``nodes`` (number: weight, weight of class 1) of all its nodes, ``splits`` (number: feature, gain)."""

    label: int
    number: int
    tree: Tree
    nodes: dict = field(default_factory=dict)
    splits: dict = field(default_factory=dict)
    open: list = field(default_factory=lambda: [1])

    def importance(self, n_features: int) -> np.ndarray:
        """Gain of each feature over the weights of its nodes, all of them 1, without splits whose leaves are of one class."""
        out = np.zeros(n_features)

        def leaf_class(node: int) -> int | None:
            if node not in self.splits:
                n, s = self.nodes[node]
                return int(s > n - s)
            left, right = leaf_class(2 * node), leaf_class(2 * node + 1)
            if left is not None and left == right:
                return left
            feature, gain = self.splits[node]
            out[feature] += gain
            return None

        leaf_class(1)
        return out / out.sum() if out.sum() else out


@dataclass
class _Level:
    """What a pass counts for one tree: ``columns``, those of the features that any of its open nodes drew, and of
    (column, open node) the ``cells`` of the nodes' own features, node after node. ``slot`` is by node where its places begin."""

    label: int
    number: int
    tree: Tree
    nodes: list
    totals: list
    slot: np.ndarray
    columns: np.ndarray
    cells: np.ndarray
    of: list


def _level(grown: _Grown, bins: Bins, seed: int, n_features: int, n_drawn: int) -> _Level:
    drawn = [drawn_features(seed, grown.number, node, n_features, n_drawn) for node in grown.open]
    of = [np.concatenate([np.arange(a, b) for a, b in zip(bins.offset[f], bins.offset[f + 1], strict=True)]) for f in drawn]
    columns = np.unique(np.concatenate(of)).astype(np.int64)
    slot = np.full(2 << grown.tree.depth, len(grown.open), dtype=np.intp)  # rows of closed nodes are counted apart
    slot[grown.open] = np.arange(len(grown.open))
    cells = np.concatenate([i + (len(drawn) + 1) * np.searchsorted(columns, c) for i, c in enumerate(of)])
    return _Level(grown.label, grown.number, grown.tree, grown.open, [grown.nodes.get(n) for n in grown.open],
                  slot * len(PLACES), columns, cells, of)


def _counted(level: _Level, row: np.ndarray, start: np.ndarray, place: np.ndarray) -> np.ndarray:
    """(weight, weight of class 1) of a block's rows at the cells of ``level``, and last of all rows; ``place`` is by row."""
    total = np.bincount(place, minlength=len(PLACES)) @ PLACES
    width, nodes = len(level.columns), len(level.nodes) + 1
    if not width:
        return total[None]
    if level.tree.levels:
        place = level.slot[level.tree.walk(row, start, len(place))] + place
    counts = np.empty((width, nodes * len(PLACES)), dtype=np.intp)
    for i, (a, b) in enumerate(zip(start[level.columns], start[level.columns + 1], strict=True)):
        counts[i] = np.bincount(place.take(row[a:b], mode="clip"), minlength=counts.shape[1])
    found = counts.reshape(-1, len(PLACES)) @ PLACES
    return np.concatenate((found[level.cells], total[None]))


def _sums(part, levels: Sequence[_Level], seed: int, bootstrap: bool):
    """(place in ``levels``, (weight, weight of class 1) by cell and of all rows) over the blocks of a partition."""
    out: list = [None] * len(levels)
    by_tree: dict[int, list[int]] = {}
    for i, level in enumerate(levels):
        by_tree.setdefault(level.number, []).append(i)
    for (row, start, y), ids in part:
        y = y.astype(np.intp)
        four, weights = -1, None
        for number in sorted(by_tree):
            if bootstrap and number // 4 != four:
                four = number // 4
                weights = 2 * bootstrap_weights(ids, four, seed)
            for i in by_tree[number]:
                found = _counted(levels[i], row, start, y[levels[i].label] + (weights[number % 4] if bootstrap else 2))
                out[i] = found if out[i] is None else out[i] + found
    return ((i, x) for i, x in enumerate(out) if x is not None)


def _best(level: _Level, sums: np.ndarray, bins: Bins) -> list:
    """(node, weight, weight of class 1, column or -1, the same two weights on its other side, gain) of each open node."""
    out, at = [], 0
    for node, total, of in zip(level.nodes, level.totals, level.of, strict=True):
        n, s = total or tuple(sums[-1])
        if not len(of):
            out.append((node, n, s, -1, 0.0, 0.0, 0.0))
            continue
        mine, full = sums[at:at + len(of)].T, np.zeros(bins.columns)
        at += len(of)
        sides = []
        for x in mine:
            full[of] = x
            sides.append(bins.sides(full)[of])
        n1, s1 = sides
        n2, off = n - n1, s1 * n - s * n1
        can = (n1 > 0) & (n2 > 0)
        gain = np.where(can, off * off / np.where(can, n * n1 * n2, 1.0), 0.0)  # half of weight x Gini gain
        j = int(gain.argmax())
        if gain[j] > 0:
            out.append((node, n, s, int(of[j]), n1[j], s1[j], gain[j]))
        else:
            out.append((node, n, s, -1, 0.0, 0.0, 0.0))
    return out


def _split(grown: _Grown, found: list, bins: Bins) -> None:
    """Grow the tree by a level."""
    grown.open, level = [], []
    last = len(grown.tree.levels) + 1 == grown.tree.depth
    for node, n, s, j, n1, s1, gain in found:
        grown.nodes[node] = n, s
        if j < 0:
            continue
        usual, other = (2 * node, 2 * node + 1) if bins.usual_left[j] else (2 * node + 1, 2 * node)
        grown.splits[node] = int(bins.feature[j]), gain
        grown.tree.usual[node] = usual
        level.append((node, int(bins.lo[j]), int(bins.hi[j]), other))
        for child, a, b in ((other, n1, s1), (usual, n - n1, s - s1)):
            grown.nodes[child] = a, b
            if not last and 0 < b < a:
                grown.open.append(child)
    grown.tree.levels.append(level)


def _passes(levels: list[_Level]) -> list[list[int]]:
    """The places of ``levels``, dealt to passes of at most ``CELLS`` sums."""
    out, held = [], CELLS + 1
    for i, level in enumerate(levels):
        if held + len(level.cells) > CELLS:
            out.append([])
            held = 0
        out[-1].append(i)
        held += len(level.cells)
    return out


def forest_importances(rows: DataFrame, labels: Sequence[str], n_features: int, n_trees: int, depth: int, seed: int = 42,
                       max_bins: int = 32, bootstrap: bool = True, n_drawn: int | None = None, features: str = "features",
                       n_rows: int | None = None) -> dict[str, np.ndarray]:
    """Importance of each feature (summed gain, 1 a tree, then all of them 1) in a forest for each of the 0/1 ``labels``.

    A node looks at ``n_drawn`` features, the root of their number unless given. A tree's draws do not depend on the label.
    """
    n = n_rows or rows.count()
    drawn = n_drawn or math.ceil(math.sqrt(n_features))
    numbered = rows.select(features, *labels, F.monotonically_increasing_id().alias("_number"))
    raw = sparse_blocks(numbered, labels, n, features, "_number")
    bins = find_bins(raw.map(lambda b: b[0]), n, n_features, max_bins)
    shared = raw.context.broadcast(bins)
    blocks = raw.map(lambda b: (binned(b[0], shared.value), b[1])).persist(StorageLevel.MEMORY_AND_DISK)
    blocks.count()
    raw.unpersist()
    parts = blocks.getNumPartitions()
    forest = [_Grown(t, i, Tree(depth)) for i in range(n_trees) for t in range(len(labels))]
    for _ in range(depth):
        growing = [g for g in forest if g.open]
        levels = [_level(g, bins, seed, n_features, drawn) for g in growing]
        for places in _passes(levels):
            sent = raw.context.broadcast([levels[i] for i in places])
            found = (blocks.mapPartitions(lambda part, sent=sent: _sums(part, sent.value, seed, bootstrap))
                     .reduceByKey(np.add, min(parts, len(places)))
                     .map(lambda kv, sent=sent: (kv[0], _best(sent.value[kv[0]], kv[1], shared.value))).collect())
            for i, best in found:
                _split(growing[places[i]], best, bins)
            sent.destroy()
    blocks.unpersist()
    shared.destroy()
    out = {}
    for t, label in enumerate(labels):
        total = sum(g.importance(n_features) for g in forest if g.label == t)
        out[label] = total / total.sum() if total.sum() else total
    return out
