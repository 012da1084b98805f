import math
import random

import pytest

from pyspark.sql import functions as F

from clinical_cohort.operators import evaluation as EV


def _data(spark, n=300, seed=5):
    random.seed(seed)
    rows = []
    for i in range(n):
        y = 1 if random.random() < 0.3 else 0
        s = round(min(0.999, max(0.0, random.gauss(0.35 + 0.3 * y, 0.2))), 2)  # ties on purpose
        rows.append((i, y, s))
    return rows, spark.createDataFrame(rows, "id long, label int, score double")


def _brute(rows):
    P = sum(r[1] for r in rows)
    N = len(rows) - P
    pts = [(0.0, 0.0)]
    pr = [(0.0, 1.0)]
    for s in sorted({r[2] for r in rows}, reverse=True):
        tp = sum(1 for r in rows if r[2] >= s and r[1] == 1)
        fp = sum(1 for r in rows if r[2] >= s and r[1] == 0)
        pts.append((fp / N, tp / P))
        pr.append((tp / P, tp / (tp + fp)))
    roc = sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(pts, pts[1:]))
    pra = sum((r2 - r1) * (p1 + p2) / 2 for (r1, p1), (r2, p2) in zip(pr, pr[1:]))
    return roc, pra, pts


def test_auc_matches_trapezoid(spark):
    rows, df = _data(spark)
    roc, pra, pts = _brute(rows)
    got = EV.auc_summary(df).collect()[0]
    assert math.isclose(got.roc_auc, roc, rel_tol=1e-12)  # operators return full precision
    assert math.isclose(got.pr_auc, pra, rel_tol=1e-12)
    curve = sorted((r.fpr, r.tpr) for r in EV.roc_curve(df).collect())
    assert len(curve) == len(pts)
    assert all(a == pytest.approx(b, rel=1e-12) for a, b in zip(curve, sorted(pts), strict=True))


def test_running_counts_cross_bucket(spark):
    rows, df = _data(spark, 200, 9)
    d = EV.distinct_scores(df)
    got = {r.score: (r.tp, r.fp) for r in EV.running_counts(d, n_buckets=4).collect()}
    for s, (tp, fp) in got.items():
        assert tp == sum(1 for r in rows if r[2] >= s and r[1] == 1)
        assert fp == sum(1 for r in rows if r[2] >= s and r[1] == 0)


def test_running_counts_clustered_scores(spark):
    # All scores inside one thousandth of [0, 1]: the buckets still split them.
    random.seed(11)
    rows = [(i, random.randint(0, 1), round(random.random() / 1000, 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, label int, score double")
    d = EV.distinct_scores(df)
    parts = EV.value_buckets(d, "score", 8).groupBy("_b").count().collect()
    assert len(parts) == 8 and max(r["count"] for r in parts) < 100
    desc = {r.score: r._b for r in EV.value_buckets(d, "score", 8, descending=True).collect()}
    ordered = [desc[k] for k in sorted(desc)]
    assert ordered == sorted(ordered, reverse=True)  # bucket 0 holds the highest scores
    got = {r.score: (r.tp, r.fp) for r in EV.running_counts(d, n_buckets=8).collect()}
    assert len(got) == len({r[2] for r in rows})
    for s, (tp, fp) in got.items():
        assert tp == sum(1 for r in rows if r[2] >= s and r[1] == 1)
        assert fp == sum(1 for r in rows if r[2] >= s and r[1] == 0)


def test_histogram_reliability_brier(spark):
    rows, df = _data(spark)
    hist = {r.bin: r["count"] for r in EV.score_histogram(df).collect()}
    assert sorted(hist) == list(range(10)) and sum(hist.values()) == len(rows)
    rel = EV.reliability(df).collect()
    assert sum(r["count"] for r in rel) == len(rows)
    b = EV.brier(df).collect()[0].brier
    assert math.isclose(b, round(sum((r[2] - r[1]) ** 2 for r in rows) / len(rows), 6), abs_tol=1e-6)


def test_classification_report(spark):
    rows = [(1, 1), (1, 0), (0, 0), (0, 0), (1, 1), (0, 1)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    rep = {r["class"]: r for r in EV.classification_report(df).collect()}
    assert math.isclose(rep["1"].precision, 2 / 3, abs_tol=1e-6) and math.isclose(rep["1"].recall, 2 / 3, abs_tol=1e-6)
    assert math.isclose(rep["accuracy"].f1, 4 / 6, rel_tol=1e-12) and rep["weighted avg"].support == 6


def test_curves_on_empty_and_single_score(spark):
    empty = spark.createDataFrame([], "id long, label int, score double")
    assert EV.auc_summary(empty).collect()[0].n is None
    assert [(r.fpr, r.tpr) for r in EV.roc_curve(empty).collect()] == [(0.0, 0.0)]
    one = spark.createDataFrame([(1, 1, 0.5), (2, 0, 0.5)], "id long, label int, score double")
    got = EV.auc_summary(one).collect()[0]
    assert got.roc_auc == 0.5 and got.n == 2
