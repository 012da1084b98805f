"""Decision trees of a grid search, those of all folds and grid points grown side by side.

The trees are those of Spark's ``RandomForestClassifier`` with one tree and no bootstrap: Gini gain over binned
features, as many features a node as asked for and drawn as Spark draws them, leaves of a least size. What differs
is the cost: rows are binned once for all fits, one job serves a level of all trees, and trees of a fold that are the
same so far are counted once. The bins of a fold come from all its training rows, not from a sample of 10 000.

Sums are added and splits chosen on the executors; splits and the class counts of leaves reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boosting import Bins, Tree, binned, merged_counts, sparse_blocks, thresholds, value_counts
from .forest import CELLS

_LONG = (1 << 64) - 1


class _JavaRandom:
    """java.util.Random: the numbers that a seed gives in Spark's forests."""

    def __init__(self, seed: int):
        self.seed = (seed ^ 0x5DEECE66D) & ((1 << 48) - 1)

    def _next(self) -> int:
        self.seed = (self.seed * 0x5DEECE66D + 0xB) & ((1 << 48) - 1)
        x = self.seed >> 16
        return x - (1 << 32) if x >> 31 else x

    def next_long(self) -> int:
        return ((self._next() << 32) + self._next()) & _LONG


def _murmur3(data: bytes, h: int) -> int:
    """MurmurHash3 (32 bits) of whole words."""
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF
        h ^= ((k << 15 | k >> 17) & 0xFFFFFFFF) * 0x1B873593 & 0xFFFFFFFF
        h = ((h << 13 | h >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


@lru_cache(maxsize=4096)
def drawn(number: int, n_features: int, n_drawn: int) -> tuple[int, ...]:
    """``n_drawn`` of the features, by Spark's reservoir sampling with the seed ``number``, in its order."""
    data = number.to_bytes(8, "big")
    low = _murmur3(data, 0x3C074A61)
    x, out = _murmur3(data, low) << 32 | low, list(range(n_drawn))
    for item in range(n_drawn, n_features):
        bits = []
        for n in (26, 27):
            x ^= x << 21 & _LONG
            x ^= x >> 35
            x ^= x << 4 & _LONG
            bits.append(x & ((1 << n) - 1))
        at = int(((bits[0] << 27) + bits[1]) * 2.0 ** -53 * (item + 1))
        if at < n_drawn:
            out[at] = item
    return tuple(out)


@dataclass
class Fit:
    """A tree in the making. By heap number (root 1): ``nodes``, the rows of class 0 and 1; ``splits``, (feature, threshold)."""

    max_features: int
    min_leaf: int
    fold: int
    tree: Tree
    random: _JavaRandom
    nodes: dict = field(default_factory=dict)
    splits: dict = field(default_factory=dict)
    open: list = field(default_factory=lambda: [1])  # in the order in which Spark draws their features
    draws: list = field(default_factory=list)

    @property
    def shape(self):
        return self.fold, tuple(map(tuple, self.tree.levels)), tuple(self.open)


@dataclass
class _Job:
    """Nodes that are counted once for all ``fits`` (draws of each open node, least leaf) that have them."""

    fold: int
    tree: Tree
    open: list
    totals: list
    columns: np.ndarray
    fits: list


def _job(fits: Sequence[Fit], bins: Bins) -> _Job:
    features = np.unique(np.concatenate([d for f in fits for d in f.draws])) if any(len(d) for f in fits for d in f.draws) else []
    columns = [np.arange(bins.offset[f], bins.offset[f + 1]) for f in features]
    one = fits[0]
    return _Job(one.fold, one.tree, one.open, [one.nodes.get(n) for n in one.open],
                np.concatenate(columns) if columns else np.zeros(0, int), [(f.draws, f.min_leaf) for f in fits])


def _places(job: _Job, row, start, fold) -> np.ndarray:
    """For each row of a block the place of its node among the open ones, one past them if none or held out."""
    slot = np.full(2 << job.tree.depth, len(job.open), dtype=np.intp)
    slot[job.open] = np.arange(len(job.open))
    return np.where(fold == job.fold, len(job.open), slot[job.tree.walk(row, start, len(fold))])


def _sums(part, jobs: Sequence[_Job]):
    """(place in ``jobs``, (rows of class 0 and 1 by column and open node, and last of the open nodes)) over a partition."""
    out: list = [None] * len(jobs)
    for (row, start, y), fold in part:
        for i, job in enumerate(jobs):
            width = 2 * (len(job.open) + 1)
            code = 2 * _places(job, row, start, fold) + y[0]
            found = np.empty((len(job.columns) + 1, width), dtype=np.int64)
            for j, (a, b) in enumerate(zip(start[job.columns], start[job.columns + 1], strict=True)):
                found[j] = np.bincount(code.take(row[a:b], mode="clip"), minlength=width)
            found[-1] = np.bincount(code, minlength=width)
            out[i] = found if out[i] is None else out[i] + found
    return ((i, x) for i, x in enumerate(out) if x is not None)


def _gini(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    n = np.maximum(zeros + ones, 1)
    return np.where(zeros + ones > 0, 1.0 - (zeros / n) * (zeros / n) - (ones / n) * (ones / n), 0.0)


def _best(job: _Job, sums: np.ndarray, bins: Bins, allowed: np.ndarray) -> list:
    """For each fit and open node (class counts, column or -1, class counts on its left). Ties: the first feature drawn."""
    out = [[] for _ in job.fits]
    for i, total in enumerate(job.totals):
        total = tuple(sums[-1, 2 * i:2 * i + 2].tolist()) if total is None else total
        full = np.zeros((2, bins.columns))
        full[:, job.columns] = sums[:-1, 2 * i:2 * i + 2].T
        other = np.array([bins.sides(x) for x in full])
        parent = np.array(total, dtype=np.float64)
        left = np.where(bins.usual_left, parent[:, None] - other, other)
        right = parent[:, None] - left
        n, n1, n2 = parent.sum(), left.sum(axis=0), right.sum(axis=0)
        gain = _gini(*parent) - n1 / max(n, 1) * _gini(*left) - n2 / max(n, 1) * _gini(*right)
        for (draws, least), found in zip(job.fits, out, strict=True):
            at = [np.arange(bins.offset[f], bins.offset[f + 1]) for f in draws[i]]
            at = np.concatenate(at) if at else np.zeros(0, int)
            at = at[allowed[at] & (n1[at] >= least) & (n2[at] >= least)]
            j = int(at[gain[at].argmax()]) if len(at) else -1
            if j < 0 or gain[j] <= 0:
                found.append((total, -1, None))
            else:
                found.append((total, j, tuple(left[:, j].astype(np.int64).tolist())))
    return out


def _split(fit: Fit, found: list, bins: Bins) -> None:
    """Grow the tree by a level."""
    stack, level = [], []
    last = len(fit.tree.levels) + 1 == fit.tree.depth
    for node, (total, j, left) in zip(fit.open, found, strict=True):
        fit.nodes[node] = total
        if j < 0:
            continue
        f = int(bins.feature[j])
        fit.splits[node] = f, float(bins.thresholds[f][j - bins.offset[f]])
        usual, other = (2 * node, 2 * node + 1) if bins.usual_left[j] else (2 * node + 1, 2 * node)
        fit.tree.usual[node] = usual
        level.append((node, int(bins.lo[j]), int(bins.hi[j]), other))
        for child, c in ((2 * node, left), (2 * node + 1, (total[0] - left[0], total[1] - left[1]))):
            fit.nodes[child] = c
            if not last and abs(_gini(*map(np.array, c))) >= np.finfo(float).eps:
                stack.append(child)
    fit.tree.levels.append(level)
    fit.open = stack[::-1]


def _fold_bins(blocks: RDD, sizes: np.ndarray, n_features: int, max_bins: int) -> tuple[Bins, np.ndarray]:
    """The bins that the thresholds of all folds make, and for each fold whether a column is a threshold of its own."""
    folds = len(sizes)

    def counts(part):
        seen: dict = {}
        for (row, feature, value, _), fold in part:
            of = fold[row]
            for k in range(folds):
                for f, found in value_counts(feature[of == k], value[of == k]):
                    seen[f, k] = merged_counts(seen[f, k], found) if (f, k) in seen else found
        yield from seen.items()

    def cuts(pair):
        f, by = pair
        by, out = dict(by), []
        for k in range(folds):
            rest = [by[i] for i in sorted(by) if i != k]
            some = rest[0] if rest else (np.zeros(0), np.zeros(0))
            for r in rest[1:]:
                some = merged_counts(some, r)
            out.append(thresholds(*some, int(sizes.sum() - sizes[k]), max_bins))
        return f, out

    parts = blocks.getNumPartitions()
    found = dict(blocks.mapPartitions(counts).reduceByKey(merged_counts, parts).map(lambda kv: (kv[0][0], (kv[0][1], kv[1])))
                 .groupByKey(parts).map(cuts).collect())
    none = [np.zeros(0)] * folds
    bins = Bins([np.unique(np.concatenate(found.get(f, none))) for f in range(n_features)])
    allowed = np.zeros((folds, bins.columns), dtype=bool)
    for f, by in found.items():
        for k in range(folds):
            allowed[k, bins.offset[f] + np.searchsorted(bins.thresholds[f], by[k])] = True
    return bins, allowed


def search(rows: DataFrame, n_rows: int, n_features: int, points: Sequence[tuple[int, int]], depth: int, folds: int, seed: int, label: str,
           fold: str, max_bins: int = 32) -> list[tuple[Fit, dict]]:
    """For each of ``points`` (features a node, least leaf) and each number of the column ``fold``: the tree of depth ``depth``
    fitted on the other rows, and by its leaf (heap number) how many of the fold's rows are of class 0 and 1."""
    raw = sparse_blocks(rows, [label], n_rows, number=fold)
    sizes = np.zeros(folds, dtype=np.int64)
    for s in raw.map(lambda b: np.bincount(b[1], minlength=folds)).collect():
        sizes += s
    bins, allowed = _fold_bins(raw, sizes, n_features, max_bins)
    shared = raw.context.broadcast((bins, allowed))
    blocks = raw.map(lambda b: (binned(b[0], shared.value[0]), b[1].astype(np.int16))).persist(StorageLevel.MEMORY_AND_DISK)
    blocks.count()
    raw.unpersist()
    parts = blocks.getNumPartitions()
    fits = [Fit(min(f, n_features), m, k, Tree(depth), _JavaRandom(seed)) for f, m in points for k in range(folds)]

    def alike(some):
        out: dict = {}
        for fit in some:
            out.setdefault(fit.shape, []).append(fit)
        return list(out.values())

    def chosen(sent, kv):
        bins, allowed = shared.value
        job = sent.value[kv[0]]
        return kv[0], _best(job, kv[1], bins, allowed[job.fold])

    for _ in range(depth):
        growing = [f for f in fits if f.open]
        for fit in growing:
            fit.draws = [drawn(fit.random.next_long(), n_features, fit.max_features) if fit.max_features < n_features else range(n_features)
                         for _ in fit.open]
        groups = alike(growing)
        jobs = [_job(g, bins) for g in groups]
        passes, held = [], CELLS + 1
        for i, job in enumerate(jobs):
            if held + len(job.columns) * len(job.open) > CELLS:
                passes.append([])
                held = 0
            passes[-1].append(i)
            held += len(job.columns) * len(job.open)
        for places in passes:
            sent = raw.context.broadcast([jobs[i] for i in places])
            found = (blocks.mapPartitions(lambda part, sent=sent: _sums(part, sent.value)).reduceByKey(np.add, min(parts, len(places)))
                     .map(lambda kv, sent=sent: chosen(sent, kv)).collect())
            for i, by_fit in found:
                for fit, best in zip(groups[places[i]], by_fit, strict=True):
                    _split(fit, best, bins)
            sent.destroy()
    groups = alike(fits)
    sent = raw.context.broadcast([(g[0].fold, g[0].tree) for g in groups])

    def leaves(part):
        out = np.zeros((len(sent.value), 4 << depth), dtype=np.int64)
        for (row, start, y), of in part:
            for i, (k, tree) in enumerate(sent.value):
                held = of == k
                out[i] += np.bincount(2 * tree.walk(row, start, len(of))[held].astype(np.intp) + y[0][held], minlength=4 << depth)
        yield out

    counted = sum(blocks.mapPartitions(leaves).collect())
    blocks.unpersist()
    shared.destroy()
    seen = {id(f): counted[i].reshape(-1, 2) for i, g in enumerate(groups) for f in g}
    return [(f, {int(node): tuple(seen[id(f)][node].tolist()) for node in np.flatnonzero(seen[id(f)].any(axis=1))}) for f in fits]


def with_folds(rows: DataFrame, key: str, seed: int, folds: int) -> DataFrame:
    """``rows`` with ``_fold``, by a hash of their key."""
    return rows.withColumn("_fold", F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(folds)))
