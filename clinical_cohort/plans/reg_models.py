"""Registered queries: feature selection, evaluation, models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calibration as CAL
from ..operators import evaluation as EV
from ..operators import features as FE
from ..operators import models as ML
from ..operators import selection as SEL
from ..operators.sampling import best_features, rank_features, stratified_split
from ..sources.files import load_targets
from .phenotype import families
from .registry import register
from .roles import Roles, cte
from .reg_io import q_feature_labels
from .reg_features import _ALL_FAMILIES_SQL, _FM_CTE, _TARGETS_SQL
from .study import Sizes, Study

K_FEATURES = 150  # features kept per target, as in the reference
SPLIT_SEED = 42
# Registered model sizes. Trees, boosting rounds and folds are the reference's 300,
# 500 and 5; its tree grid has 2 020 points (depth 2-5, 50-150 features a split,
# leaves of 11-15). The registered keys search the points below, on every row and
# every feature; the depths of a point are read off one fit (README).
FOREST_TREES = 300
GBT_ROUNDS = 500
TREE_GRID = ((2, 3, 4, 5), (50, 75, 100, 125, 150), (11, 12, 13, 14, 15))
CV_FOLDS = 5
_STUDY_SIZES = Sizes(n_features=K_FEATURES, forest_trees=FOREST_TREES, boosting_rounds=GBT_ROUNDS, depths=TREE_GRID[0],
                     max_features=TREE_GRID[1], min_leaf=TREE_GRID[2], folds=CV_FOLDS, seed=SPLIT_SEED)
_MADE: dict = {}


def _once(what: str, spark, sf, make):
    """``make()`` once per session and folder: keys that read the same fitted model share it."""
    at = (what, spark.sparkContext.applicationId, sf)
    if at not in _MADE:
        _MADE[at] = make()
    return _MADE[at]


def _study(spark, sf) -> Study:
    return _once("study", spark, sf, lambda: Study(Roles(spark, sf), sizes=_STUDY_SIZES))


_CHI2_SQL = _ALL_FAMILIES_SQL + _TARGETS_SQL.replace("\n, t AS", ", t AS") + """
, tl AS (SELECT visit_occurrence_id, 'fulfilled' AS target, fulfilled AS label FROM t
         UNION ALL SELECT visit_occurrence_id, 'urgent', urgent FROM t)
, sh AS (SELECT target, CAST(count_if(label = 0) AS DOUBLE) / count(*) AS s0,
                CAST(count_if(label = 1) AS DOUBLE) / count(*) AS s1 FROM tl GROUP BY 1)
, per AS (SELECT target, feature, CAST(sum(value) AS DOUBLE) AS t,
                 CAST(sum(CASE WHEN label = 0 THEN value ELSE 0 END) AS DOUBLE) AS o0,
                 CAST(sum(CASE WHEN label = 1 THEN value ELSE 0 END) AS DOUBLE) AS o1
          FROM fm JOIN tl USING (visit_occurrence_id) GROUP BY 1, 2)
, sc AS (SELECT per.target, feature,
           (o0 - s0 * t) * (o0 - s0 * t) / (s0 * t) + (o1 - s1 * t) * (o1 - s1 * t) / (s1 * t) AS score
         FROM per JOIN sh ON per.target = sh.target)
, rk AS (SELECT target, feature, score, CAST(row_number() OVER (PARTITION BY target ORDER BY round(score, 6) DESC NULLS LAST, feature ASC) AS INTEGER) AS rank FROM sc)
"""


def _target_scores(spark, sf, feats=None):
    """Chi-square scores (six families, every target), to the 6 places that the keys give, so that ties are ties."""
    r = Roles(spark, sf)
    feats = FE.feature_matrix(families(r, r.targets)) if feats is None else feats
    targets = load_targets(r.targets, "visit_occurrence_id", "recorded_at")
    scores = SEL.chi2_scores_by_target(feats, targets, ["fulfilled", "urgent"])
    return scores.withColumn("score", F.round("score", 6))


@register("fs_chi2", _FM_CTE + _CHI2_SQL + f"""
SELECT feature, round(score, 6) AS score, rank FROM rk WHERE target = 'fulfilled' AND rank <= {K_FEATURES}""")
def q_fs_chi2(spark, sf):
    r = Roles(spark, sf)
    labels = load_targets(r.targets, "visit_occurrence_id", "recorded_at").select("visit_occurrence_id", F.col("fulfilled").alias("label"))
    scores = SEL.chi2_scores(FE.feature_matrix(families(r, r.targets)), labels).withColumn("score", F.round("score", 6))
    return SEL.top_k(scores, K_FEATURES).join(scores, "feature").select("feature", "score", "rank")


@register("fs_chi2_per_target", _FM_CTE + _CHI2_SQL + f"""
SELECT target, feature, round(score, 6) AS score, rank FROM rk WHERE rank <= {K_FEATURES}""")
def q_fs_chi2_per_target(spark, sf):
    """The chi-square selection for every target column, one pass over the features of all six families."""
    return SEL.top_k_by_target(_target_scores(spark, sf), K_FEATURES)


@register("fs_minmax", cte("measurement", "visit_occurrence") + """
, w AS (SELECT visit_occurrence_id, 'METBL_' || measurement_source_value AS feature, max(value_as_number) AS value
        FROM measurement GROUP BY 1, 2)
, n AS (SELECT count(DISTINCT visit_occurrence_id) AS n FROM visit_occurrence)
SELECT feature,
  CASE WHEN count(*) < max(n.n) THEN least(min(value), 0.0) ELSE min(value) END AS min_value,
  CASE WHEN count(*) < max(n.n) THEN greatest(max(value), 0.0) ELSE max(value) END AS max_value
FROM w, n GROUP BY feature""")
def q_fs_minmax(spark, sf):
    r = Roles(spark, sf)
    return SEL.minmax_features(_largest_measures(r), keys=r.visit_occurrence)


def _largest_measures(r):
    name = F.concat(F.lit("METBL_"), F.col("measurement_source_value")).alias("feature")
    return r.measurement.groupBy("visit_occurrence_id", name).agg(F.max("value_as_number").alias("value"))


@register("fs_minmax_scaled", cte("measurement", "visit_occurrence") + """
, w AS (SELECT visit_occurrence_id, 'METBL_' || measurement_source_value AS feature, max(value_as_number) AS value
        FROM measurement GROUP BY 1, 2)
, n AS (SELECT count(DISTINCT visit_occurrence_id) AS n FROM visit_occurrence)
, g AS (SELECT feature,
  CASE WHEN count(*) < max(n.n) THEN least(min(value), 0.0) ELSE min(value) END AS lo,
  CASE WHEN count(*) < max(n.n) THEN greatest(max(value), 0.0) ELSE max(value) END AS hi
  FROM w, n GROUP BY feature)
SELECT visit_occurrence_id, feature, round(CASE WHEN hi = lo THEN 0.0 ELSE (value - lo) / (hi - lo) END, 6) AS value
FROM w JOIN g USING (feature)""", digits=6)
def q_fs_minmax_scaled(spark, sf):
    r = Roles(spark, sf)
    w = _largest_measures(r)
    return SEL.minmax_scale(w, SEL.minmax_features(w, keys=r.visit_occurrence))


# Selections that SQL can make too: by chi-square for either target, and by support.
_GIVEN_SQL = _FM_CTE + _CHI2_SQL + f"""
, u AS (SELECT feature, 'xChi-2' AS sel FROM rk WHERE target = 'fulfilled' AND rank <= {K_FEATURES}
        UNION ALL SELECT feature, 'xChi-2 urgent' FROM rk WHERE target = 'urgent' AND rank <= {K_FEATURES}
        UNION ALL SELECT feature, 'Support' FROM (SELECT feature, row_number() OVER (ORDER BY count(*) DESC, feature ASC) AS n FROM fm GROUP BY 1)
                  WHERE n <= {K_FEATURES})
, v AS (SELECT feature AS "Feature", CAST(max(CASE WHEN sel = 'xChi-2' THEN 1 ELSE 0 END) AS INT) AS "xChi-2",
               CAST(max(CASE WHEN sel = 'xChi-2 urgent' THEN 1 ELSE 0 END) AS INT) AS "xChi-2 urgent",
               CAST(max(CASE WHEN sel = 'Support' THEN 1 ELSE 0 END) AS INT) AS "Support", CAST(count(*) AS INT) AS "Total"
        FROM u GROUP BY 1)
"""


def _given_votes(spark, sf, n=None):
    r = Roles(spark, sf)
    feats = FE.feature_matrix(families(r, r.targets))
    chi = SEL.top_k_by_target(_target_scores(spark, sf, feats), K_FEATURES)
    # Both selections need the values, so the plan shuffles the features once for the two.
    support = SEL.top_k(SEL.support_scores(feats.where("value > 0")), K_FEATURES)
    by = {"xChi-2": chi.where("target = 'fulfilled'"), "xChi-2 urgent": chi.where("target = 'urgent'"), "Support": support}
    return SEL.vote_table(by, n)


@register("fs_vote_table", _GIVEN_SQL + f"""
SELECT *, CAST(row_number() OVER (ORDER BY "Total" DESC, "Feature" DESC) AS INTEGER) AS "Rank" FROM v QUALIFY "Rank" <= {K_FEATURES}""")
def q_fs_vote_table(spark, sf):
    """L7 over given selector outputs."""
    return _given_votes(spark, sf, K_FEATURES)


@register("rank_features", _GIVEN_SQL + f"""
SELECT "Feature", "Total", CAST(row_number() OVER (ORDER BY "Total" DESC, "Feature" DESC) AS INTEGER) AS "Rank" FROM v
QUALIFY "Rank" <= {K_FEATURES}""")
def q_rank_features(spark, sf):
    return rank_features(_given_votes(spark, sf).select("Feature", "Total"), K_FEATURES)


@register("best_features_per_target", _GIVEN_SQL + f"""
, bt AS (SELECT tt.target, "Feature" AS feature, CAST(CASE WHEN tt.target = 'fulfilled' THEN "xChi-2" ELSE "xChi-2 urgent" END + "Support" AS INT) AS score
        FROM v, (SELECT 'fulfilled' AS target UNION ALL SELECT 'urgent') tt)
SELECT target, feature, score, CAST(row_number() OVER (PARTITION BY target ORDER BY score DESC, feature DESC) AS INTEGER) AS rank
FROM bt WHERE score > 0 AND NOT contains(feature, 'person_id') QUALIFY rank <= {K_FEATURES}""")
def q_best_features_per_target(spark, sf):
    """The best features of each target by the votes it gets."""
    votes = _given_votes(spark, sf)
    by_target = [F.struct(F.lit(t).alias("target"), (F.col(c) + F.col("Support")).cast("int").alias("score"))
                 for t, c in (("fulfilled", "xChi-2"), ("urgent", "xChi-2 urgent"))]
    scores = votes.select(F.col("Feature").alias("feature"), F.inline(F.array(*by_target))).where("score > 0")
    return best_features(scores, K_FEATURES).select("target", "feature", "score", "rank")


@register("stratified_split", cte("visit_occurrence") + """
, h AS (SELECT visit_occurrence_id, discharge_to_source_value, count(*) OVER (PARTITION BY discharge_to_source_value) AS n,
          row_number() OVER (PARTITION BY discharge_to_source_value
            ORDER BY md5(concat_ws('|', coalesce(CAST(visit_occurrence_id AS VARCHAR), ''), '42')), visit_occurrence_id) AS rn
        FROM visit_occurrence)
SELECT visit_occurrence_id, discharge_to_source_value,
       CASE WHEN rn <= round(n * 0.8) THEN 'train' WHEN rn <= round(n * 0.9) THEN 'validation' ELSE 'test' END AS split
FROM h""")
def q_stratified_split(spark, sf):
    v = Roles(spark, sf).visit_occurrence.select("visit_occurrence_id", "discharge_to_source_value")
    return stratified_split(v, "discharge_to_source_value", ["visit_occurrence_id"], seed=SPLIT_SEED)


# ------------------------------------------------------------- evaluation (scores role)

_D_SQL = """
, d AS (SELECT CAST(score AS DOUBLE) AS score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
               sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg FROM scores GROUP BY 1)
, r AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp FROM d)
, tot AS (SELECT CAST(sum(pos) AS DOUBLE) AS P, CAST(sum(neg) AS DOUBLE) AS N FROM d)
"""


@register("eval_roc", cte("scores") + _D_SQL + """
SELECT score AS threshold, round(fp / N, 6) AS fpr, round(tp / P, 6) AS tpr FROM r, tot
UNION ALL SELECT NULL, 0.0, 0.0""", digits=6)
def q_eval_roc(spark, sf):
    return EV.roc_curve(Roles(spark, sf).scores)


@register("eval_pr", cte("scores") + _D_SQL + """
SELECT score AS threshold, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision, round(tp / P, 6) AS recall FROM r, tot
UNION ALL SELECT NULL, 1.0, 0.0""", digits=6)
def q_eval_pr(spark, sf):
    return EV.pr_curve(Roles(spark, sf).scores)


@register("eval_auc", cte("scores") + _D_SQL + """
, x AS (SELECT CAST(tp AS DOUBLE) AS tp, CAST(fp AS DOUBLE) AS fp, CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg FROM r)
SELECT round(sum(neg * (tp + tp - pos)) / (2.0 * sum(pos) * sum(neg)), 6) AS roc_auc,
       round(sum(pos * (tp / (tp + fp) + CASE WHEN (tp - pos) + (fp - neg) > 0 THEN (tp - pos) / ((tp - pos) + (fp - neg)) ELSE 1.0 END)) / (2.0 * sum(pos)), 6) AS pr_auc,
       round(sum(pos) / (sum(pos) + sum(neg)), 6) AS no_skill, CAST(sum(pos) + sum(neg) AS BIGINT) AS n,
       CAST(sum(pos) AS BIGINT) AS positives
FROM x""", digits=6)
def q_eval_auc(spark, sf):
    return EV.auc_summary(Roles(spark, sf).scores)


@register("eval_brier", cte("scores") + "SELECT round(avg(pow(score - label, 2)), 6) AS brier FROM scores", digits=6)
def q_eval_brier(spark, sf):
    return EV.brier(Roles(spark, sf).scores)


@register("eval_reliability", cte("scores") + """
SELECT CAST(least(floor(score * 10), 9) AS INT) AS bin, round(avg(score), 6) AS mean_predicted,
       round(avg(CAST(label AS DOUBLE)), 6) AS fraction_positive, count(*) AS count
FROM scores GROUP BY 1""", digits=6)
def q_eval_reliability(spark, sf):
    return EV.reliability(Roles(spark, sf).scores)


@register("eval_score_hist", cte("scores") + """
, c AS (SELECT CAST(least(floor(score * 10), 9) AS INT) AS bin, count(*) AS cnt FROM scores GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM (SELECT unnest(range(0, 10)) AS bin) b LEFT JOIN c ON b.bin = c.bin""")
def q_eval_score_hist(spark, sf):
    return EV.score_histogram(Roles(spark, sf).scores)


@register("eval_minmax_score", cte("scores") + """
SELECT doc_id, label, score,
  round((score - (SELECT min(score) FROM scores)) / ((SELECT max(score) FROM scores) - (SELECT min(score) FROM scores)), 6) AS score_scaled
FROM scores""", digits=6)
def q_eval_minmax_score(spark, sf):
    return EV.minmax_score(Roles(spark, sf).scores)


@register("ml_isotonic", cte("scores") + """
, d AS (SELECT score, CAST(sum(label) AS DOUBLE) AS pos, CAST(count(*) AS DOUBLE) AS n FROM scores GROUP BY 1)
, c AS (SELECT score, pos, n, row_number() OVER (ORDER BY score) AS i, sum(pos) OVER (ORDER BY score) AS cp, sum(n) OVER (ORDER BY score) AS cn FROM d)
, least_to AS (SELECT a.i AS a, b.i AS b, min((b.cp - a.cp + a.pos) / (b.cn - a.cn + a.n)) OVER (PARTITION BY a.i ORDER BY b.i DESC) AS m
               FROM c a JOIN c b ON b.i >= a.i)
, f AS (SELECT c.score, max(m) AS isotonic FROM c JOIN least_to l ON l.b = c.i GROUP BY 1)
SELECT s.doc_id, s.label, s.score, round(f.isotonic, 6) AS isotonic FROM scores s JOIN f ON s.score = f.score""", digits=6)
def q_ml_isotonic(spark, sf):
    """Exact isotonic calibration of the scores, by the largest least mean (SQL) and by pooling (Spark)."""
    s = Roles(spark, sf).scores.select("doc_id", "label", "score")
    return CAL.isotonic_apply(s, CAL.isotonic_fit(s))


@register("eval_class_report", cte("scores") + """
, p AS (SELECT CAST(label AS VARCHAR) AS y, CAST(CAST(score >= 0.5 AS INT) AS VARCHAR) AS p FROM scores)
, cls AS (SELECT y AS class FROM p UNION SELECT p FROM p)
, per AS (SELECT class, (SELECT count(*) FROM p WHERE y = class) AS support,
                 (SELECT count(*) FROM p WHERE p.p = class) AS predicted,
                 (SELECT count(*) FROM p WHERE y = class AND p.p = class) AS tp FROM cls)
, m AS (SELECT class, support, tp,
          CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / predicted END AS precision,
          CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / support END AS recall FROM per)
, f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM m)
, t AS (SELECT sum(support) AS total FROM f)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / max(total), 6), CAST(max(total) AS BIGINT) FROM f, t
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(max(total) AS BIGINT) FROM f, t
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / max(total), 6), round(sum(recall * support) / max(total), 6),
  round(sum(f1 * support) / max(total), 6), CAST(max(total) AS BIGINT) FROM f, t""", digits=6)
def q_eval_class_report(spark, sf):
    s = Roles(spark, sf).scores.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return EV.classification_report(s)


# ------------------------------------------------------------- model fitting (rows-only checks)

def _ml_inputs(spark, sf):
    return _once("inputs", spark, sf, lambda: _make_inputs(spark, sf))


def _tuned_tree(spark, sf):
    X, _ = _ml_inputs(spark, sf)
    return _once("tree", spark, sf, lambda: ML.tree_cv(_split(X, "train"), *TREE_GRID, folds=CV_FOLDS))


def _make_inputs(spark, sf):
    """All six families (rare names dropped) and age as one vector per visit, split 80/10/10 by class.

    The vectors are read by every iteration of a fit, so they are written once; so are the features, which
    are read for their names and for the vectors.
    """
    from ..functions.dates import age_by_year
    from ..session import materialize, written

    r = Roles(spark, sf)
    feats = written(FE.feature_matrix(families(r, r.visit_occurrence)))
    p = r.person.select("person_id", "birth_datetime")
    labels = r.visit_occurrence.join(p, "person_id", "left").select(
        "visit_occurrence_id", (F.col("discharge_to_source_value") == "F").cast("int").alias("label"),
        age_by_year("visit_end_datetime", "birth_datetime").alias("age"))
    names = ML.feature_names(feats)
    data = stratified_split(labels, "label", ["visit_occurrence_id"], seed=SPLIT_SEED)
    return materialize(ML.design_matrix(feats, data, names, ["age"])), [*names, "age"]


def _split(X, name):
    return X.where(F.col("split") == name)


def _register_selector(key: str, selector: str) -> None:
    @register(key)
    def q(spark, sf):
        return _study(spark, sf).selected(selector)


for _key, _selector in (("fs_l1", "Logistics"), ("fs_rfe", "RFE"), ("fs_forest", "Random Forest"), ("fs_gbt", "GradientBoosting")):
    _register_selector(_key, _selector)


@register("ml_tree_cv")
def q_ml_tree_cv(spark, sf):
    X, _ = _ml_inputs(spark, sf)
    return EV.classification_report(ML.predict(_tuned_tree(spark, sf), _split(X, "test")))


@register("ml_calibrate")
def q_ml_calibrate(spark, sf):
    X, _ = _ml_inputs(spark, sf)
    tree = _tuned_tree(spark, sf)
    return ML.calibrate(ML.predict(tree, _split(X, "validation")), ML.predict(tree, _split(X, "test")))


@register("ml_tree_rules")
def q_ml_tree_rules(spark, sf):
    _, names = _ml_inputs(spark, sf)
    return ML.readable_rules(ML.tree_rules(spark, _tuned_tree(spark, sf), names), F.broadcast(q_feature_labels(spark, sf)))


# ------------------------------------------------------------- the job for every target

@register("fs_vote")
def q_fs_vote(spark, sf):
    """The vote of the five selectors for every target."""
    return _study(spark, sf).votes


@register("ml_predictions")
def q_ml_predictions(spark, sf):
    """Test rows of every target with the prediction and score of its tuned tree."""
    return _study(spark, sf).predictions


@register("study_report")
def q_study_report(spark, sf):
    return _study(spark, sf).report()


@register("study_rules")
def q_study_rules(spark, sf):
    """The trees of all targets as rows, with readable names."""
    return _study(spark, sf).rules(q_feature_labels(spark, sf))


@register("study_explained")
def q_study_explained(spark, sf):
    """The predictions again, by walking the rules over the long feature table."""
    return _study(spark, sf).explained()


@register("study_calibrated")
def q_study_calibrated(spark, sf):
    return _study(spark, sf).calibrated()


@register("ml_baseline_logistic")
def q_ml_baseline_logistic(spark, sf):
    """The plain logistic model beside the tree, scored on the test split."""
    X, names = _ml_inputs(spark, sf)
    model = ML.baseline_logistic(_split(X, "train"))
    return EV.auc_summary(ML.predict(model, _split(X, "test")))
