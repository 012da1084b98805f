"""Boosting and elimination over sparse rows against Spark's own, and the jobs that they take."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from clinical_cohort.operators import boosting, l1
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
        out.append((i, v, int(a), int(b)))
    return spark.createDataFrame(out, ["visit_occurrence_id", "features", "a", "b"]).cache()


def test_boosting_equals_sparks(rows):
    got = boosting.boosted_importances(rows, ["a", "b"], P, 4, 3)
    for t in ("a", "b"):
        want = GBTClassifier(labelCol=t, maxIter=4, maxDepth=3, seed=42).fit(rows).featureImportances.toArray()
        assert got[t] == pytest.approx(want, abs=1e-9)


def test_sums_made_anew_change_nothing(rows, monkeypatch):
    want = boosting.boosted_importances(rows, ["a"], P, 5, 2)["a"]
    monkeypatch.setattr(boosting, "REPLAY", 2)
    monkeypatch.setattr(boosting, "COLLECTED", 0)
    assert boosting.boosted_importances(rows, ["a"], P, 5, 2)["a"] == pytest.approx(want, abs=1e-12)


def test_all_labels_grow_in_one_job_a_level(spark, rows):
    sc = spark.sparkContext
    sc.setJobGroup("boosting", "")
    before = len(sc.statusTracker().getJobIdsForGroup("boosting"))
    boosting.boosted_importances(rows, ["a", "b"], P, 6, 3)
    jobs = len(sc.statusTracker().getJobIdsForGroup("boosting")) - before
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 6 * 3 + 6  # Spark's own takes more for one label: a job a level, and others a round


def test_l1_fit_is_the_optimum(rows):
    def objective(w, b, label):
        x = np.array([r.features.toArray() for r in rows.collect()])
        y = np.array([2 * r[label] - 1 for r in rows.collect()])
        return np.logaddexp(0, -y * (x @ w + b)).mean() + 1 / (0.3 * N) * np.abs(w).sum()

    fits = l1.L1Logistic(rows, ["a", "b"], P, N)
    for t in ("a", "b"):
        w, base = fits.fit(t, 1 / (0.3 * N), range(P))
        model = LogisticRegression(labelCol=t, elasticNetParam=1.0, regParam=1 / (0.3 * N), maxIter=500, tol=1e-10,
                                   standardization=False).fit(rows)
        assert w == pytest.approx(model.coefficients.toArray(), abs=1e-3)
        assert objective(w, base - w @ fits.mean, t) <= objective(model.coefficients.toArray(), model.intercept, t) + 1e-9
    fits.close()


def test_elimination_equals_refits_of_spark(rows, monkeypatch):
    names = [f"f{i:02d}" for i in range(P)]
    got = {r.feature for r in ML.rfe_select(rows, names, 4, step=3, label="a").collect()}
    monkeypatch.setattr(l1, "MOST_FEATURES", 0)
    assert got == {r.feature for r in ML.rfe_select(rows, names, 4, step=3, label="a").collect()} and "f02" in got


def test_labels_other_than_0_and_1_fail(rows):
    with pytest.raises(Exception, match="labels are 0 or 1"):
        boosting.boosted_importances(rows.withColumn("a", F.lit(2)), ["a"], P, 1, 1)


def test_margins_alone_are_kept_between_rounds(spark, rows, monkeypatch):
    """What a round keeps is the rows' margins, not their blocks; a level is counted by the entries of the smaller children's rows."""
    kept = []
    was = boosting._zippable
    monkeypatch.setattr(boosting, "_zippable", lambda rdd: kept.append(rdd.first()) or was(rdd))
    want = boosting.boosted_importances(rows, ["a", "b"], P, 3, 3)
    assert [len(k) for k in kept] == [5, 2, 2, 2]  # a block, and (margins, sums) of three rounds
    assert kept[2][0].shape == kept[0][2].shape
    block = boosting.by_row(boosting.binned(boosting.sparse_blocks(rows, ["a", "b"], N).first(), boosting.Bins([np.array([0.5])] * 10 + [np.array([-9.0, 9.0]), np.array([])])), 12)
    row, start, _, column, first = block
    by_row = sorted(zip(np.repeat(np.arange(len(first) - 1), np.diff(first)).tolist(), column.tolist(), strict=True))
    assert by_row == sorted(zip(row.tolist(), np.repeat(np.arange(12), np.diff(start)).tolist(), strict=True))
    for t in ("a", "b"):
        model = GBTClassifier(labelCol=t, maxIter=3, maxDepth=3, seed=42).fit(rows)
        assert want[t] == pytest.approx(model.featureImportances.toArray(), abs=1e-9)


def test_blocks_hold_entries_in_few_bytes(spark):
    """0/1 features take 3 bytes an entry and their row number 2; other values stay as they are."""
    whole = spark.createDataFrame([(Vectors.sparse(5, [(1, 1.0), (4, 200.0)]), 1)], ["features", "a"])
    row, feature, value, _ = boosting.sparse_blocks(whole, ["a"], 1).first()
    assert (row.dtype, feature.dtype, value.dtype) == (np.uint16, np.uint16, np.uint8)
    assert feature.tolist() == [1, 4] and value.tolist() == [1, 200]
    for v in (0.5, -1.0, 300.0):
        _, _, value, _ = boosting.sparse_blocks(whole.select(F.lit(1).alias("a")).crossJoin(
            spark.createDataFrame([(Vectors.dense([v, 2.0]),)], ["features"])), ["a"], 1).first()
        assert value.dtype == np.float64 and value.tolist() == [v, 2.0]
    v, n = dict(boosting.value_counts(np.array([3, 3], np.uint16), np.array([200, 100], np.uint8)))[3]
    assert boosting.thresholds(v, n, 2, 32).tolist() == [150.0]
