"""Boosted trees for several 0/1 labels of the same sparse rows.

The trees are those of Spark's ``GBTClassifier``: variance gain over binned
features, log loss, the first tree at full weight and the others at ``step``.
What differs is the cost of a level of a tree:

* a block of rows keeps only the entries outside the bin of 0, by column, so that a
  pass costs what the rows hold and not rows x features;
* one job serves a level of the trees of all labels;
* only the smaller child of a split is counted, by the entries of its own rows, the other is what remains of the parent;
* bins come from the values of all rows, not from a sample of 10 000.

Sums by (node, column) and the trees reach the driver; rows never do.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one block; a row's number within its block fits 16 bits.
BLOCK_ROWS = 32_768
#: Distinct values of a feature that are kept with their counts; of more, as many by equal weight.
DISTINCT = 65_536
#: Rounds after which the sums of the rows are made anew from the trees, so that lineage stays short.
REPLAY = 25
#: Bytes of partial sums that the driver adds; more are added by the executors first.
COLLECTED = 64 << 20


def _compact(feature: np.ndarray, value: np.ndarray):
    """The entries of a block in as few bytes as hold them exactly: 3 with 0/1 features, for 12."""
    if len(feature) and feature.max() < 1 << 16:
        feature = feature.astype(np.uint16)
    if len(value) and 0 <= value.min() and value.max() <= 255:
        whole = value.astype(np.uint8)
        value = whole if (whole == value).all() else value
    return feature, value


def sparse_blocks(rows: DataFrame, labels: Sequence[str], n: int, features: str = "features", number: str | None = None) -> RDD:
    """(row, feature, value, labels) of blocks of ``n`` rows: the entries that are not 0, and an array (label, row).
    With ``number``, a column of integers, pairs of that and the rows' numbers."""
    parts = max(1, min(rows.sparkSession.sparkContext.defaultParallelism, -(-n // (BLOCK_ROWS // 4))))

    def block(batches):
        table = pa.Table.from_batches(batches)
        vectors, *ys = (table.column(i).combine_chunks() for i in range(1 + len(labels)))
        if vectors.null_count:
            raise ValueError("a row has no features")
        _, _, at, values = vectors.flatten()
        dense, sizes = at.is_null().to_numpy(zero_copy_only=False), np.diff(values.offsets.to_numpy())
        row = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        feature, value = place.astype(np.int32), values.flatten().to_numpy()
        feature[np.repeat(~dense, sizes)] = at.flatten().to_numpy()
        y = np.array([c.to_numpy(zero_copy_only=False) for c in ys], dtype=np.float64)
        if not np.isin(y, (0.0, 1.0)).all():
            raise ValueError("labels are 0 or 1")
        present = value != 0
        made = row[present], *_compact(feature[present], value[present]), y.astype(np.int8)
        return (made, table.column(1 + len(labels)).to_numpy()) if number else made

    def sent(batches):
        return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block(batches), 5)], pa.binary())], ["block"])

    def gather(batches):
        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, BLOCK_ROWS - n))
                n, at = n + held[-1].num_rows, at + held[-1].num_rows
                if n == BLOCK_ROWS:
                    yield sent(held)
                    held, n = [], 0
        if n:
            yield sent(held)

    dealt = rows.select(features, *labels, *[number] if number else []).repartition(parts)
    plain = dealt.select(F.unwrap_udt(features), *[F.col(c).cast("double") for c in labels], *[F.col(number).cast("bigint")] if number else [])
    return plain.mapInArrow(gather, "block binary").rdd.map(lambda r: pickle.loads(r[0])).persist(StorageLevel.MEMORY_AND_DISK)


@dataclass
class Bins:
    """Thresholds of each feature. A column stands for a bin other than that of 0, and for the split that has the
    column's bins on one side (``lo`` to ``hi``) and all else, rows without an entry too, on the ``usual`` side."""

    thresholds: list[np.ndarray]

    def __post_init__(self):
        sizes = np.array([len(t) for t in self.thresholds], dtype=np.int64)
        self.offset = np.concatenate(([0], np.cumsum(sizes)))
        self.zero = np.array([np.searchsorted(t, 0.0) for t in self.thresholds], dtype=np.int64)
        self.many = np.flatnonzero(sizes > 1)
        self.columns = int(self.offset[-1])
        self.feature = np.repeat(np.arange(len(sizes)), sizes)
        column = np.arange(self.columns)
        self.usual_left = column - self.offset[self.feature] >= self.zero[self.feature]
        self.lo = np.where(self.usual_left, column, self.offset[self.feature])
        self.hi = np.where(self.usual_left, self.offset[self.feature + 1], column + 1)

    def sides(self, sums: np.ndarray) -> np.ndarray:
        """Sums over ``lo`` to ``hi`` of each column; ``sums`` are those of the columns."""
        out = sums.copy()
        for f in self.many:
            a, b, z = self.offset[f], self.offset[f + 1], self.offset[f] + self.zero[f]
            out[a:z] = np.cumsum(sums[a:z])
            out[z:b] = np.cumsum(sums[z:b][::-1])[::-1]
        return out


def value_counts(feature: np.ndarray, value: np.ndarray):
    """(feature, (values, counts)) of each feature of a block's entries."""
    order = np.lexsort((value, feature))
    f, v = feature[order], value[order]
    new = np.flatnonzero(np.concatenate(([True], (f[1:] != f[:-1]) | (v[1:] != v[:-1])))) if len(f) else np.array([], int)
    n = np.diff(np.concatenate((new, [len(f)])))
    starts = np.flatnonzero(np.concatenate(([True], f[new][1:] != f[new][:-1]))) if len(new) else np.array([], int)
    for a, b in zip(starts, np.concatenate((starts[1:], [len(new)])), strict=True):
        yield int(f[new[a]]), (v[new[a:b]].astype(np.float64), n[a:b].astype(np.float64))


def merged_counts(a, b):
    """(values, counts) of both, at most ``DISTINCT`` values."""
    v, at = np.unique(np.concatenate((a[0], b[0])), return_inverse=True)
    n = np.bincount(at, weights=np.concatenate((a[1], b[1])))
    if len(v) <= DISTINCT:
        return v, n
    total = np.cumsum(n)
    kept = np.unique(np.searchsorted(total, np.linspace(total[-1] / DISTINCT, total[-1], DISTINCT)).clip(max=len(v) - 1))
    return v[kept], np.diff(np.concatenate(([0.0], total[kept])))


def thresholds(v: np.ndarray, n: np.ndarray, rows: int, max_bins: int) -> np.ndarray:
    """As Spark finds them, from the counts of all values that are not 0: midpoints, or every ``n / max_bins`` rows if there are more."""
    zeros = rows - n.sum()
    if zeros > 0:
        at = np.searchsorted(v, 0.0)
        v, n = np.insert(v, at, 0.0), np.insert(n, at, zeros)
    most = int(min(max_bins, rows))
    if len(v) <= most:
        return (v[1:] + v[:-1]) / 2
    out, stride, so_far = [], rows / most, n[0]
    target = stride
    for i in range(1, len(v)):
        before, so_far = so_far, so_far + n[i]
        if abs(before - target) < abs(so_far - target):
            out.append((v[i - 1] + v[i]) / 2)
            target += stride
    return np.array(out)


def find_bins(blocks: RDD, rows: int, n_features: int, max_bins: int = 32) -> Bins:
    """The bins of each feature by its ``thresholds``."""
    def counts(part):
        seen: dict[int, tuple] = {}
        for _, feature, value, _ in part:
            for at, found in value_counts(feature, value):
                seen[at] = merged_counts(seen[at], found) if at in seen else found
        yield from seen.items()

    cuts = dict(blocks.mapPartitions(counts).reduceByKey(merged_counts, blocks.getNumPartitions(), int)
                .mapValues(lambda found: thresholds(*found, rows, max_bins)).collect())
    return Bins([cuts.get(f, np.array([])) for f in range(n_features)])


def binned(block, bins: Bins):
    """(row numbers by column, where each column starts, labels) of a block."""
    row, feature, value, y = block
    order = np.argsort(feature, kind="stable")
    row, feature, value = row[order], feature[order], value[order]
    size = np.diff(bins.offset)
    first = np.array([t[0] if len(t) else np.inf for t in bins.thresholds])
    bin_ = (value > first[feature]).astype(np.int64)
    for f in bins.many:
        a, b = np.searchsorted(feature, (f, f + 1))
        bin_[a:b] = np.searchsorted(bins.thresholds[f], value[a:b])
    zero = bins.zero[feature]
    keep = (bin_ != zero) & (size[feature] > 0)
    column = (bins.offset[feature] + bin_ - (bin_ > zero))[keep]
    order = np.argsort(column, kind="stable")
    return row[keep][order], np.searchsorted(column[order], np.arange(bins.columns + 1)).astype(np.int32), y


def by_row(block, columns: int):
    """A binned block, with the columns by row and where each row starts."""
    row, start, y = block
    column = np.repeat(np.arange(columns, dtype=np.uint16 if columns <= 1 << 16 else np.int32), np.diff(start))
    ends = np.cumsum(np.bincount(row, minlength=y.shape[1]))
    return row, start, y, column[np.argsort(row, kind="stable")], np.concatenate(([0], ends)).astype(np.int32)


@dataclass
class Tree:
    """A tree by heap number (root 1): where the rows of a node usually go, and the columns whose rows go to the other child."""

    depth: int
    usual: np.ndarray = None
    value: np.ndarray = None
    levels: list = field(default_factory=list)

    def __post_init__(self):
        self.usual = np.arange(2 << self.depth, dtype=np.int16)
        self.value = np.zeros(2 << self.depth)

    def walk(self, row: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
        """The node of each of the ``n`` rows of a block."""
        at = np.ones(n, dtype=np.int16)
        for level in self.levels:
            after = self.usual[at]
            for node, lo, hi, other in level:
                r = row[start[lo]:start[hi]]
                after[r[at[r] == node]] = other
            at = after
        return at


def residuals(y: np.ndarray, margin: np.ndarray | None) -> np.ndarray:
    """What the next tree is fitted to: -1 or 1 at first, then the gradient of the log loss."""
    sign = 2.0 * y - 1.0
    return sign if margin is None else 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))


def _level_sums(part, trees, slots, n_slots, columns: int, counted: bool):
    """For each label (counts, sums) by slot and column, and (rows, sum) of all rows, over the blocks of a partition."""
    out = None
    for (row, start, y, column, first), margin in part:
        found, size = [], np.diff(first)
        for t, tree in enumerate(trees):
            if not n_slots[t]:
                found.append((np.zeros((0, columns)), np.zeros((0, columns)), np.zeros(2)))
                continue
            g = residuals(y[t], None if margin is None else margin[t])
            total = np.array([len(g), g.sum()])
            cells = n_slots[t] * columns
            if tree.levels:
                slot = slots[t][tree.walk(row, start, len(g))]
                rows = np.flatnonzero(slot >= 0)
                mine = size[rows]
                at = np.repeat(first[rows] - (np.cumsum(mine) - mine), mine)  # where the entries of ``rows`` are
                at += np.arange(len(at))
                key = np.repeat(slot[rows] * columns, mine)
                key += column[at]
                g = g[rows]
            else:
                mine, key = size, column
            n = np.bincount(key, minlength=cells).astype(np.float64) if counted else np.zeros(cells)
            found.append((n.reshape(-1, columns), np.bincount(key, weights=np.repeat(g, mine), minlength=cells).reshape(-1, columns), total))
        out = found if out is None else [tuple(a + b for a, b in zip(x, z, strict=True)) for x, z in zip(out, found, strict=True)]
    if out is not None:
        yield out


def _zippable(rdd: RDD) -> RDD:
    """``rdd`` kept object by object: ``zip`` would write those of two such RDDs anew to make their batches alike."""
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1))


def _added(a, b):
    return [tuple(x + z for x, z in zip(p, q, strict=True)) for p, q in zip(a, b, strict=True)]


def _grown(tree: Tree, nodes: dict, bins: Bins, importance: np.ndarray) -> list:
    """Split ``nodes`` (number: rows, sum, counts and sums by column); -> (parent, smaller, larger) where children can split."""
    level, families = [], []
    last = len(tree.levels) + 1 == tree.depth
    for node, (n, s, counts, sums) in nodes.items():
        n1, s1 = bins.sides(counts), bins.sides(sums)
        n2, s2 = n - n1, s - s1
        can = (n1 > 0) & (n2 > 0)
        gain = np.where(can, s1 * s1 / np.where(can, n1, 1) + s2 * s2 / np.where(can, n2, 1) - s * s / n, -1.0)
        j = int(gain.argmax()) if len(gain) else -1
        if j < 0 or gain[j] <= 1e-14 * n:
            tree.value[node] = s / n
            continue
        usual, other = (2 * node, 2 * node + 1) if bins.usual_left[j] else (2 * node + 1, 2 * node)
        importance[bins.feature[j]] += gain[j]
        tree.usual[node] = usual
        level.append((node, int(bins.lo[j]), int(bins.hi[j]), other))
        tree.value[other], tree.value[usual] = s1[j] / n1[j], s2[j] / n2[j]
        a, b = (other, n1[j], s1[j]), (usual, n2[j], s2[j])
        if not last:
            families.append((node, *((a, b) if n1[j] <= n2[j] else (b, a))))
    tree.levels.append(level)
    return families


def boosted_importances(rows: DataFrame, labels: Sequence[str], n_features: int, rounds: int, depth: int, step: float = 0.1,
                        max_bins: int = 32, features: str = "features") -> dict[str, np.ndarray]:
    """Importance of each feature (summed gain, all of them 1) in ``rounds`` boosted trees, for each of the 0/1 ``labels``."""
    n = rows.count()
    raw = sparse_blocks(rows, labels, n, features)
    bins = find_bins(raw, n, n_features, max_bins)
    shared = raw.context.broadcast(bins)
    columns, n_labels = bins.columns, len(labels)
    blocks = _zippable(raw.map(lambda b: by_row(binned(b, shared.value), columns))).persist(StorageLevel.MEMORY_AND_DISK)
    importance = [np.zeros(n_features) for _ in labels]
    forests: list[list[Tree]] = []
    if not blocks.count() or not columns:
        return {t: i for t, i in zip(labels, importance, strict=True)}
    raw.unpersist()

    def gathered(found, n_slots):
        if 16 * sum(n_slots) * columns * found.getNumPartitions() > COLLECTED:
            return found.treeReduce(_added, 2)
        first, *rest = found.collect()
        for r in rest:
            first = _added(first, r)
        return first

    def moved(block, margin, later, at):
        """The margins of a block after the trees of the rounds ``later``, the first of which is round ``at``."""
        row, start, y, *_ = block
        margin = np.zeros(y.shape) if margin is None else margin.copy()
        for m, trees in enumerate(later, at):
            for t, tree in enumerate(trees):
                margin[t] += (step if m else 1.0) * tree.value[tree.walk(row, start, y.shape[1])]
        return margin

    def begun(part, later, at, trees, counted):
        """The margins of each block after ``later``, the last with the sums that the root of the next trees needs."""
        margins = []

        def kept():
            for block, state in part:
                margins.append(moved(block, state and state[0], later, at) if later else None)
                yield block, margins[-1]

        sums = next(_level_sums(kept(), trees, [None] * n_labels, [1] * n_labels, columns, counted), None)
        return ((margin, sums if i + 1 == len(margins) else None) for i, margin in enumerate(margins))

    state = old = root_counts = None
    for m in range(rounds):
        trees = [Tree(depth) for _ in labels]
        if state is None or m % REPLAY == 0:
            sent = raw.context.broadcast(list(forests))
            made = blocks.mapPartitions(lambda part, late=sent, trees=trees, counted=root_counts is None:
                                        begun(((b, None) for b in part), late.value, 0, trees, counted))
        else:
            made = blocks.zip(state).mapPartitions(lambda part, late=forests[-1:], at=m - 1, trees=trees: begun(part, late, at, trees, False))
        old, state = state, _zippable(made).persist(StorageLevel.MEMORY_AND_DISK)
        found = gathered(state.flatMap(lambda s: [] if s[1] is None else [s[1]]), [1] * n_labels)
        if old is not None:
            old.unpersist()
        if root_counts is None:
            root_counts = [f[0][0] for f in found]
        nodes = [{1: (total[0], total[1], root_counts[t], s[0])} for t, (_, s, total) in enumerate(found)]
        for d in range(depth):
            families = [_grown(trees[t], nodes[t], bins, importance[t]) for t in range(n_labels)]
            if not any(families):
                break
            slots = [np.full(2 << depth, -1) for _ in labels]
            for t, mine in enumerate(families):
                for i, (_, small, _) in enumerate(mine):
                    slots[t][small[0]] = i
            n_slots = [len(mine) for mine in families]
            found = gathered(blocks.zip(state).mapPartitions(lambda part: _level_sums(
                ((block, margin) for block, (margin, _) in part), trees, slots, n_slots, columns, True)), n_slots)
            after = [{} for _ in labels]
            for t, mine in enumerate(families):
                for i, (parent, small, large) in enumerate(mine):
                    counts, s = found[t][0][i], found[t][1][i]
                    after[t][small[0]] = (small[1], small[2], counts, s)
                    after[t][large[0]] = (large[1], large[2], nodes[t][parent][2] - counts, nodes[t][parent][3] - s)
            nodes = after
        forests.append(trees)
    if state is not None:
        state.unpersist()
    blocks.unpersist()
    shared.destroy()
    return {t: i / i.sum() if i.sum() else i for t, i in zip(labels, importance, strict=True)}
