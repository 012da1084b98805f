"""The forest over sparse rows against Spark's own, its draws, and the jobs that it takes."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clinical_cohort.operators import forest
from clinical_cohort.operators import models as ML

N, P = 700, 12


@pytest.fixture(scope="module")
def rows(spark):
    """Ten 0/1 features, one of many values and a constant; two labels that follow some of them. Sparse and dense rows."""
    random.seed(7)
    out = []
    for i in range(N):
        x = [float(random.random() < 0.3) for _ in range(10)] + [round(random.gauss(0, 20), 1), 3.0]
        a = random.random() < 0.15 + 0.5 * x[2] + 0.2 * x[5] * (x[10] > 4)
        b = random.random() < 0.7 - 0.5 * x[7]
        v = Vectors.dense(x) if i % 3 == 0 else Vectors.sparse(P, [(j, w) for j, w in enumerate(x) if w])
        out.append((i, v, int(a), int(b), i % 3))
    return spark.createDataFrame(out, ["visit_occurrence_id", "features", "a", "b", "three"]).cache()


@pytest.mark.parametrize("depth", [1, 3, 5])
def test_tree_equals_sparks(rows, depth):
    got = forest.forest_importances(rows, ["a", "b"], P, 1, depth, bootstrap=False, n_drawn=P)
    for t in ("a", "b"):
        model = RandomForestClassifier(labelCol=t, numTrees=1, maxDepth=depth, bootstrap=False, featureSubsetStrategy="all", seed=1).fit(rows)
        assert got[t] == pytest.approx(model.featureImportances.toArray(), abs=1e-9)


def test_forest_is_like_sparks(rows):
    got = forest.forest_importances(rows, ["a", "b"], P, 300, 5)
    for t in ("a", "b"):
        model = RandomForestClassifier(labelCol=t, numTrees=300, maxDepth=5, seed=3).fit(rows)
        assert got[t] == pytest.approx(model.featureImportances.toArray(), abs=0.02)


def test_result_depends_on_nothing_but_rows_and_seed(rows, monkeypatch):
    want = forest.forest_importances(rows, ["a", "b"], P, 20, 4)
    monkeypatch.setattr(forest, "CELLS", 40)  # a few trees a pass
    got = forest.forest_importances(rows, ["b"], P, 20, 4)["b"]
    assert got.tolist() == want["b"].tolist()
    assert forest.forest_importances(rows, ["b"], P, 20, 4, seed=43)["b"].tolist() != got.tolist()


def test_bootstrap_weights():
    ids = np.concatenate((np.arange(40_000), (7 << 33) + np.arange(40_000)))
    w = np.concatenate([forest.bootstrap_weights(ids, g, 42) for g in range(3)])
    for k, share in enumerate((0.3679, 0.3679, 0.1839, 0.0613, 0.0153)):
        assert (w == k).mean(axis=1) == pytest.approx(share, abs=0.008)
    assert np.corrcoef(w) == pytest.approx(np.eye(12), abs=0.02)
    assert np.corrcoef(w[:, :-1].ravel(), w[:, 1:].ravel())[0, 1] == pytest.approx(0, abs=0.01)
    assert forest.bootstrap_weights(ids[::-1], 0, 42).tolist() == w[:4, ::-1].tolist()


def test_all_labels_grow_in_one_job_a_level(spark, rows):
    sc = spark.sparkContext
    sc.setJobGroup("forest", "")
    before = len(sc.statusTracker().getJobIdsForGroup("forest"))
    ML.forest_select_by_target(rows, [f"f{i:02d}" for i in range(P)], 5, ["a", "b"], n_trees=30, max_depth=5)
    jobs = len(sc.statusTracker().getJobIdsForGroup("forest")) - before
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 5 + 6  # Spark's own takes more for one label


def test_other_classes_and_deep_trees_are_sparks(rows):
    names = [f"f{i:02d}" for i in range(P)]
    got = ML.forest_select_by_target(rows, names, P, ["a", "three"], n_trees=5, max_depth=3)
    deep = ML.forest_select(rows, names, P, n_trees=5, max_depth=forest.MOST_DEPTH + 1, label="a")
    for found, t, depth in ((got["three"], "three", 3), (deep, "a", forest.MOST_DEPTH + 1)):
        weights = RandomForestClassifier(labelCol=t, numTrees=5, maxDepth=depth, seed=42).fit(rows).featureImportances.toArray()
        assert {r.feature: r.weight for r in found.collect()} == {n: w for n, w in zip(names, weights, strict=True) if w >= weights.mean()}
    assert got["a"].orderBy(F.desc("weight")).first().feature == "f02"


def test_labels_of_one_class_select_nothing(rows):
    assert ML.forest_select(rows.withColumn("a", F.lit(0)), [f"f{i:02d}" for i in range(P)], 5, n_trees=3, label="a").count() == 0
