"""Selection, tuned trees, rules and the job for every target, on planted and on the driver's smallest tables."""

import os
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from clinical_cohort.operators import models as ML
from clinical_cohort.operators import selection as SEL
from clinical_cohort.plans.roles import Roles
from clinical_cohort.plans.study import SELECTORS, Sizes, Study

SF = "/root/testdata/sf0.001"
KEY = "visit_occurrence_id"


@pytest.fixture(scope="module")
def planted(spark):
    """600 visits, 30 features; the label follows two of them, a second label a third."""
    random.seed(31)
    rows, labels = [], []
    for v in range(600):
        on = {f for f in range(30) if random.random() < 0.4}
        rows += [(v, f"DETBL_f{f:02d}", 1) for f in on]
        noise = random.random() < 0.1
        labels.append((v, int((3 in on or 7 in on) != noise), int((11 in on) != noise)))
    features = spark.createDataFrame(rows, f"{KEY} long, feature string, value int").cache()
    targets = spark.createDataFrame(labels, f"{KEY} long, label int, other int").cache()
    names = ML.feature_names(features)
    return features, targets, names, ML.design_matrix(features, targets, names).cache()


def test_selectors_agree_on_planted_features(planted):
    features, targets, names, x = planted
    k = 4
    votes = SEL.votes_by_target({"label": dict(zip(SELECTORS, (
        SEL.top_k(SEL.chi2_scores(features, targets), k), ML.rfe_select(x, names, k), ML.l1_select(x, names, k),
        ML.forest_select(x, names, k, n_trees=20), ML.gbt_select(x, names, k, max_iter=5, max_depth=3)), strict=True))}, 30)
    got = {r.Feature: r for r in votes.collect()}
    assert votes.columns == ["target", "Feature", *SELECTORS, "Total", "Rank"]
    assert got["DETBL_f03"].Total == got["DETBL_f07"].Total == 5
    ranked = sorted(got.values(), key=lambda r: r.Rank)
    assert {r.Feature for r in ranked[:2]} == {"DETBL_f03", "DETBL_f07"}
    assert [(r.Total, r.Feature) for r in ranked] == sorted(((r.Total, r.Feature) for r in ranked), reverse=True)
    assert all(r.Total == sum(r[s] for s in SELECTORS) for r in ranked)


def test_chi2_of_all_targets_equals_one_by_one(planted):
    features, targets, _, _ = planted
    both = SEL.chi2_scores_by_target(features, targets, ["label", "other"])
    for t in ("label", "other"):
        one = {r.feature: r.score for r in SEL.chi2_scores(features, targets, label=t).collect()}
        got = {r.feature: r.score for r in both.where(F.col("target") == t).collect()}
        assert got == pytest.approx(one)
    best = {r.target: r.feature for r in SEL.top_k_by_target(both, 1).collect()}
    assert best == {"label": best["label"], "other": "DETBL_f11"} and best["label"] in ("DETBL_f03", "DETBL_f07")


@pytest.mark.parametrize("subset", [6, 30])
def test_truncated_tree_is_the_tree_of_that_depth(planted, subset):
    _, _, _, x = planted
    deep = ML.tree_nodes(ML._tree(5, subset, 3, 42, "label").fit(x))
    for depth in (1, 2, 3, 4, 5):
        assert ML.truncated(deep, depth) == ML.tree_nodes(ML._tree(depth, subset, 3, 42, "label").fit(x))


def test_depth_scores_are_the_auc_of_each_depth(planted):
    _, _, _, x = planted
    train, held = x.where(F.col(KEY) % 3 != 0), x.where(F.col(KEY) % 3 == 0)
    got = ML.depth_scores(ML._tree(5, 30, 5, 42, "label").fit(train), held, (2, 3, 4, 5))
    for depth, auc in got.items():
        scored = ML._tree(depth, 30, 5, 42, "label").fit(train).transform(held)
        want = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="probability", metricName="areaUnderROC").evaluate(scored)
        assert auc == pytest.approx(want)
    points = ML.tree_grid(train, (2, 3), (10, 30), (3, 5), folds=3)
    assert len(points) == 8 and points[0][0] == max(p[0] for p in points) > 0.8


def test_rules_give_every_prediction(spark, planted):
    features, _, names, x = planted
    tree = ML.tree_cv(x, (2, 3, 4), (15, 30), (3, 5), folds=3)
    rules = ML.tree_rules(spark, tree, names)
    want = {r[KEY]: (r.prediction, r.score) for r in ML.predict(tree, x).collect()}
    got = {r[KEY]: (r.prediction, r.score) for r in ML.apply_rules(x, features, rules, 4).collect()}
    assert got == want and len(got) == 600
    readable = ML.readable_rules(rules, spark.createDataFrame([("DETBL_f03", "DETBL_a disease")], "feature string, readable string"))
    named = {r.feature: r.readable for r in readable.collect()}
    assert named["DETBL_f03"] == "DETBL_a disease" and named["DETBL_f07"] == "DETBL_f07" and named[None] is None


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_study_of_every_target(spark):
    study = Study(Roles(spark, SF), sizes=Sizes(n_features=20, forest_trees=5, boosting_rounds=2, depths=(2, 3), max_features=(10, 20),
                                                min_leaf=(11,), folds=2))
    votes = study.votes.collect()
    assert {r.target for r in votes} == {"fulfilled", "urgent"} and all(1 <= r.Total <= 5 for r in votes)
    assert all(len(f) <= 20 and not any("person_id" in x for x in f) for f in study.best.values())
    made = {(r.target, r[KEY]): (r.prediction, r.score) for r in study.predictions.collect()}
    n = {t: study.labels.where(F.col(f"{t}_split") == "test").count() for t in study.targets}
    assert len(made) == sum(n.values()) > 0
    assert {(r.target, r[KEY]): (r.prediction, r.score) for r in study.explained().collect()} == made
    report = study.report().collect()
    assert {r.target for r in report} == {"fulfilled", "urgent"}
    labels = study.features.select("feature", F.lower("feature").alias("readable")).distinct()
    rules = study.rules(labels).collect()
    assert all(r.readable == (r.feature.lower() if r.feature else None) for r in rules)
    calibrated = study.calibrated().collect()
    assert len(calibrated) == len(made) and all(0 <= r.isotonic <= 1 and 0 <= r.sigmoid <= 1 for r in calibrated)


def test_matrix_of_gathered_features_shuffles_no_names(spark, planted):
    """One array a visit gives the same vectors as the long table; labels without features get an empty one."""
    features, targets, names, _ = planted
    more = targets.unionByName(spark.createDataFrame([(9_999, 1, 0), (3, 1, 1)], targets.schema))
    present = features.groupBy(KEY).agg(F.collect_list("feature").alias("_present"))
    got = ML.gathered_matrix(present, more, names)
    want = ML.design_matrix(features, more, names)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 602
    assert got.where(f"{KEY} = 9999").first().features.numNonzeros() == 0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ML.gathered_matrix(present, more, names)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "UDF(" in plan[plan.index("Join LeftOuter"):]  # vectors are made below the join
