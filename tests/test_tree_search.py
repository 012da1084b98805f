"""The trees of a grid search against Spark's own fits, and the jobs that they take."""

import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clinical_cohort.operators import models as ML
from clinical_cohort.operators import tree_search as TS

N, P = 900, 24


@pytest.fixture(scope="module")
def rows(spark):
    """0/1 features of several shares, one of many values and a constant; a label that follows three of them."""
    random.seed(11)
    share = [random.choice((0.02, 0.1, 0.3, 0.5)) for _ in range(P - 2)]
    out = []
    for i in range(N):
        x = [float(random.random() < s) for s in share] + [float(random.randint(18, 95)), 3.0]
        label = random.random() < 0.15 + 0.5 * x[2] + 0.2 * x[5] * (x[P - 2] > 50)
        out.append((i, Vectors.sparse(P, [(j, w) for j, w in enumerate(x) if w]), int(label)))
    x = spark.createDataFrame(out, ["visit_occurrence_id", "features", "label"])
    return TS.with_folds(x, "visit_occurrence_id", 42, 3).cache()


@pytest.mark.parametrize("features", [4, P])
def test_trees_equal_sparks(rows, features):
    found = TS.search(rows, N, P, [(features, 3), (features, 40)], 5, 3, 42, "label", "_fold")
    assert [(fit.min_leaf, fit.fold) for fit, _ in found] == [(m, k) for m in (3, 40) for k in range(3)]
    for fit, leaves in found:
        model = ML._tree(5, features, fit.min_leaf, 42, "label").fit(rows.where(F.col("_fold") != fit.fold))
        nodes, home = ML.fitted_nodes(fit)
        assert ML.truncated(nodes, 5) == ML.tree_nodes(model)
        held = rows.where(F.col("_fold") == fit.fold)
        want = ML.depth_scores(model, held, (2, 5))
        assert ML._cut_scores(nodes, {home[leaf]: n for leaf, n in leaves.items()}, (2, 5)) == pytest.approx(want, abs=1e-12)


def test_grid_equals_fits_of_spark(rows, monkeypatch):
    got = ML.tree_grid(rows, (2, 4), (4, P), (3, 40), folds=3)
    monkeypatch.setattr(ML, "MOST_DEPTH", 0)
    assert got == ML.tree_grid(rows, (2, 4), (4, P), (3, 40), folds=3)


def test_all_trees_grow_in_one_job_a_level(spark, rows):
    sc = spark.sparkContext
    sc.setJobGroup("grid", "")
    before = len(sc.statusTracker().getJobIdsForGroup("grid"))
    ML.tree_grid(rows, (2, 5), (4, 8, 16), (3, 5, 40), folds=3)
    jobs = len(sc.statusTracker().getJobIdsForGroup("grid")) - before
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 5 + 10  # fits of Spark's take several jobs each, and there are 27 of them


def test_passes_change_nothing(rows, monkeypatch):
    want = ML.tree_grid(rows, (2, 5), (4, P), (3, 5), folds=3)
    monkeypatch.setattr(TS, "CELLS", 40)
    assert ML.tree_grid(rows, (2, 5), (4, P), (3, 5), folds=3) == want


def test_folds_have_their_own_thresholds(rows):
    blocks = TS.sparse_blocks(rows, ["label"], N, number="_fold")
    sizes = np.array([rows.where(F.col("_fold") == k).count() for k in range(3)])
    bins, allowed = TS._fold_bins(blocks, sizes, P, 8)
    age = np.arange(bins.offset[P - 2], bins.offset[P - 1])
    for k in range(3):
        values = sorted(r.features[P - 2] for r in rows.where(F.col("_fold") != k).collect())
        v, n = np.unique(values, return_counts=True)
        assert bins.thresholds[P - 2][allowed[k][age]].tolist() == TS.thresholds(v, n.astype(float), len(values), 8).tolist()


def test_other_classes_are_fitted_by_spark(rows):
    three = rows.withColumn("label", F.col("label") + (F.col("visit_occurrence_id") % 7 == 0).cast("int"))
    assert len(ML.tree_grid(three, (2,), (8,), (3,), folds=3)) == 1
