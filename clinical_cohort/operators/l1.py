"""L1-penalised logistic regression of the same rows on many subsets of their features (L3).

Recursive elimination fits a model for every few features dropped. Spark's
``LogisticRegression`` takes up to a hundred jobs a fit; here the products of
the features (X'X, once for all fits) bend every step, so that a fit takes a few
passes over the sparse rows, and the next one begins where it ended. The optimum is
that of ``LogisticRegression(elasticNetParam=1, standardization=False)``: mean log
loss + ``penalty`` x sum of |weights|, intercept free. Identical features keep
identical weights. The driver holds X'X (features squared) and the weights.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame

from .boosting import sparse_blocks

#: Features up to which X'X is made: 32 MB in the driver and in a task.
MOST_FEATURES = 2_048
#: Rows that are made dense at a time for X'X.
DENSE_ROWS = 2_048


def _gram(part, p: int):
    """(X'X, sums of X) over the blocks of a partition."""
    square, total = np.zeros((p, p)), np.zeros(p)
    for row, feature, value, y in part:
        starts = np.searchsorted(row, np.arange(0, y.shape[1] + DENSE_ROWS, DENSE_ROWS))
        for i, (a, b) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
            dense = np.zeros((DENSE_ROWS, p))
            dense[row[a:b].astype(np.int64) - i * DENSE_ROWS, feature[a:b]] = value[a:b]
            square += dense.T @ dense
            total += dense.sum(axis=0)
    yield square, total


def _gradient(part, at: int, weights: np.ndarray, intercept: float):
    """(loss, sum of residuals, gradient by feature) of one label over the blocks of a partition."""
    loss, free, out = 0.0, 0.0, np.zeros(len(weights))
    for row, feature, value, y in part:
        sign = 2.0 * y[at] - 1.0
        margin = sign * (intercept + np.bincount(row, weights=value * weights[feature], minlength=len(sign)))
        g = -sign / (1.0 + np.exp(np.minimum(margin, 700.0)))
        loss += np.logaddexp(0.0, -margin).sum()
        free += g.sum()
        out += np.bincount(feature, weights=value * g[row], minlength=len(out))
    yield loss, free, out


def _sum(a, b):
    return tuple(x + y for x, y in zip(a, b, strict=True))


class L1Logistic:
    """Fits of the 0/1 ``labels`` of ``rows`` (sparse vectors ``features``); close() frees the blocks."""

    def __init__(self, rows: DataFrame, labels: Sequence[str], n_features: int, n_rows: int):
        self.n, self.labels = n_rows, list(labels)
        self.blocks = sparse_blocks(rows, labels, n_rows)
        square, total = self.blocks.mapPartitions(lambda part: _gram(part, n_features)).treeReduce(_sum, 2)
        self.mean = total / n_rows
        centred = square / n_rows - np.outer(self.mean, self.mean)
        self.sd = np.sqrt(np.maximum(np.diag(centred), 0.0))
        self.varies = self.sd > 1e-12 * np.maximum(1.0, np.abs(self.mean))  # a constant has no weight
        by = np.where(self.varies, self.sd, 1.0)
        self.curve = centred / np.outer(by, by)

    def close(self) -> None:
        self.blocks.unpersist()

    def fit(self, label: str, penalty: float, features: Sequence[int], start=None, passes: int = 100,
            tolerance: float = 1e-6) -> tuple[np.ndarray, float]:
        """(weights of all features, 0 outside ``features``; margin at the mean row), beginning at ``start``.

        A step minimises the penalised quadratic with curvature ``bend`` x X'X. 1/4 bounds the loss from above, so that
        steps always descend; smaller ones are tried first and kept while they do.
        """
        at, n = self.labels.index(label), self.n
        use = np.array([f for f in features if self.varies[f]], dtype=np.int64)
        sd, curve = self.sd[use], self.curve[np.ix_(use, use)]
        top = float(np.linalg.eigvalsh(curve)[-1]) if len(use) else 1.0
        weights, base = np.zeros(len(self.mean)), 0.0
        if start is not None:
            weights[use], base = start[0][use], start[1]
        lasso = penalty / sd

        def look(w, b):
            shift = b - w @ self.mean
            loss, free, g = self.blocks.mapPartitions(lambda part: _gradient(part, at, w, shift)).reduce(_sum)
            return loss / n, free / n, (g / n - self.mean * free / n)[use] / sd

        loss, free, g = look(weights, base)
        bend = 0.05
        for _ in range(passes):
            u = weights[use] * sd
            v = _quadratic(g, bend, curve, top, lasso, u)
            d, db = v - u, -free / bend
            if max(np.abs(d).max(initial=0.0), abs(db)) < tolerance:
                break
            tried = weights.copy()
            tried[use] = v / sd
            found = look(tried, base + db)
            bound = loss + g @ d + free * db + bend / 2 * (d @ curve @ d + db * db)
            if found[0] > bound + 1e-12 and bend < 0.25:
                bend = min(0.25, 2 * bend)
                continue
            weights, base, (loss, free, g) = tried, base + db, found
        return weights, base


def _quadratic(g, bend, curve, top, lasso, u, steps: int = 5_000, tolerance: float = 1e-9):
    """The v that minimises g(v-u) + bend/2 (v-u)'curve(v-u) + sum(lasso |v|), by accelerated proximal steps with restart."""
    v = ahead = u
    momentum, size = 1.0, 1.0 / (bend * top)
    for _ in range(steps):
        z = ahead - size * (g + bend * (curve @ (ahead - u)))
        new = np.sign(z) * np.maximum(np.abs(z) - size * lasso, 0.0)
        if (ahead - new) @ (new - v) > 0:
            momentum = 1.0
        following = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        ahead, moved = new + (momentum - 1) / following * (new - v), np.abs(new - v).max(initial=0.0)
        v, momentum = new, following
        if moved < tolerance:
            break
    return v


def eliminate(fits: L1Logistic, label: str, names: Sequence[str], k: int, penalty: float, step: int) -> list[int]:
    """The ``k`` features left when those of smallest |weight| (ties: by name) go, ``step`` at a time, a fit before each time."""
    current, at = list(range(len(names))), None
    while len(current) > k:
        if at is None or any(at[0][i] for i in dropped):  # features of weight 0 leave the optimum where it is
            at = fits.fit(label, penalty, current, at)
        order = sorted(current, key=lambda i: (abs(at[0][i]), names[i]))
        dropped = set(order[:min(step, len(current) - k)])
        current = [i for i in current if i not in dropped]
    return current
