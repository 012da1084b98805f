"""Model evaluation tables.

Every metric is an aggregation over ``(score, label)`` or
``(label, prediction)`` rows. Curves are built on the table of *distinct*
scores (one ``groupBy``), and running sums use two levels so that no single
task has to see every score: the distinct scores are cut into
``n_buckets`` contiguous score ranges at approximate quantiles
(``value_buckets``), so buckets hold about equally many scores however the
scores cluster; per-bucket totals (at most ``n_buckets`` rows) give each
bucket its offset, and the running sum inside a bucket is a window
partitioned by bucket. Totals over the whole input (P, N) are scalar
subqueries, planned as a separate small aggregation, not as a join.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_scores(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(score, pos, neg) - positives and negatives per distinct score; rows without a label are left out."""
    y = F.col(label).cast("int")
    return df.where(y.isNotNull()).groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(F.when(y == 1, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(y == 1, 0).otherwise(1)).cast("bigint").alias("neg"))


def value_buckets(df: DataFrame, col: str, n_buckets: int | None = None, descending: bool = False,
                  out: str = "_b", relative_error: float = 0.001) -> DataFrame:
    """Add ``out``: the bucket of ``col`` among ``n_buckets`` ranges cut at approximate quantiles.

    Bucket ids follow the value order (ascending, or descending when asked;
    NaN counts as the largest value, null gets a null bucket). The split
    points come from one ``approxQuantile`` pass and at most ``n_buckets``
    numbers reach the driver; the bucket is then a pure function of the
    value (JVM-side ``Bucketizer``), so every plan that reads the result -
    and every retried task - sees the same buckets. ``n_buckets`` defaults
    to the session's shuffle partition count.
    """
    if not n_buckets:
        n_buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tmp = df.withColumn("_vb_in", F.col(col).cast("double"))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = sorted(set(tmp.approxQuantile("_vb_in", probs, relative_error))) if probs else []
    splits = [float("-inf"), *[c for c in cuts if math.isfinite(c)], float("inf")]
    if len(splits) < 3:  # no cut point (empty input or one bucket): one bucket
        return df.withColumn(out, F.when(F.col(col).isNotNull(), F.lit(0)))
    top = len(splits) - 1  # id of the NaN bucket (largest values)
    b = Bucketizer(splits=splits, inputCol="_vb_in", outputCol="_vb", handleInvalid="keep").transform(tmp)
    bucket = F.col("_vb").cast("int")
    if descending:
        bucket = F.lit(top) - bucket
    return b.withColumn(out, bucket).drop("_vb_in", "_vb")


def running_counts(scores: DataFrame, n_buckets: int | None = None) -> DataFrame:
    """Add ``tp``/``fp``: positives/negatives with score >= this score.

    Two-level prefix sums over descending score (see module docstring).
    ``n_buckets`` defaults to the session's shuffle partition count, the
    parallelism the cluster is configured for. Rows with a null score are
    left out (they have no place in the order).
    """
    # Bucket 0 holds the highest scores; equal scores share a bucket.
    s = value_buckets(scores.where(F.col("score").isNotNull()), "score", n_buckets, descending=True)
    bucket_tot = s.groupBy("_b").agg(F.sum("pos").alias("_bp"), F.sum("neg").alias("_bn"))
    w_off = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = bucket_tot.select("_b", F.coalesce(F.sum("_bp").over(w_off), F.lit(0)).alias("_op"),
                                F.coalesce(F.sum("_bn").over(w_off), F.lit(0)).alias("_on"))
    w_in = Window.partitionBy("_b").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumn("_rp", F.sum("pos").over(w_in)).withColumn("_rn", F.sum("neg").over(w_in))
    return (s.join(F.broadcast(offsets), "_b")
             .withColumn("tp", (F.col("_rp") + F.col("_op")).cast("bigint"))
             .withColumn("fp", (F.col("_rn") + F.col("_on")).cast("bigint"))
             .drop("_b", "_rp", "_rn", "_op", "_on"))


def roc_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, fpr, tpr) per distinct score plus the (null, 0, 0) start point."""
    d = distinct_scores(df, score, label)
    # Both totals from one scalar subquery, referenced once.
    tot = d.agg(F.struct(F.sum("pos").alias("P"), F.sum("neg").alias("N"))).scalar()
    r = running_counts(d).withColumn("_tot", tot)
    pts = r.select(F.col("score").alias("threshold"),
                   F.try_divide(F.col("fp").cast("double"), F.col("_tot.N")).alias("fpr"),
                   F.try_divide(F.col("tp").cast("double"), F.col("_tot.P")).alias("tpr"))
    start = d.agg(F.count(F.lit(1)).alias("_n")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def pr_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, precision, recall) per distinct score plus the (null, 1, 0) end point."""
    d = distinct_scores(df, score, label)
    P = d.agg(F.sum("pos")).scalar()
    r = running_counts(d)
    pts = r.select(F.col("score").alias("threshold"),
                   (F.col("tp").cast("double") / (F.col("tp") + F.col("fp"))).alias("precision"),
                   F.try_divide(F.col("tp").cast("double"), P).alias("recall"))
    end = d.agg(F.count(F.lit(1)).alias("_n")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def auc_summary(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row (roc_auc, pr_auc, no_skill, n, positives).

    Trapezoids need only each point and its predecessor, and the
    predecessor of a distinct score is (tp - pos, fp - neg), so both areas
    are plain sums over the running-count table. PR area is the trapezoid
    over recall starting at (recall 0, precision 1), not average precision.
    """
    d = distinct_scores(df, score, label)
    r = running_counts(d)
    tp, fp, pos, neg = (F.col(c).cast("double") for c in ("tp", "fp", "pos", "neg"))
    ptp, pfp = tp - pos, fp - neg
    prec = tp / (tp + fp)
    pprec = F.when(ptp + pfp > 0, ptp / (ptp + pfp)).otherwise(F.lit(1.0))
    P, N = F.sum(pos), F.sum(neg)
    # Totals come from the same aggregation, so no subquery is needed.
    return r.agg((F.sum(neg * (tp + ptp)) / (F.lit(2.0) * P * N)).alias("roc_auc"),
                 (F.sum(pos * (prec + pprec)) / (F.lit(2.0) * P)).alias("pr_auc"),
                 (P / (P + N)).alias("no_skill"),
                 (P + N).cast("bigint").alias("n"), P.cast("bigint").alias("positives"))


def brier(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Mean squared difference between probability and outcome."""
    return df.agg(F.avg(F.pow(F.col(score) - F.col(label).cast("double"), 2)).alias("brier"))


def score_bin(score: str | Column, n_bins: int = 10) -> Column:
    c = F.col(score) if isinstance(score, str) else score
    return F.least(F.floor(c * n_bins), F.lit(n_bins - 1)).cast("int")


def reliability(df: DataFrame, score: str = "score", label: str = "label", n_bins: int = 10) -> DataFrame:
    """Per non-empty bin the mean prediction, fraction of positives and count."""
    return df.groupBy(score_bin(score, n_bins).alias("bin")).agg(
        F.avg(score).alias("mean_predicted"), F.avg(F.col(label).cast("double")).alias("fraction_positive"),
        F.count(F.lit(1)).alias("count"))


def score_histogram(df: DataFrame, score: str = "score", n_bins: int = 10) -> DataFrame:
    """Counts of scores in ``n_bins`` equal bins of [0, 1], empty bins shown."""
    counts = df.groupBy(score_bin(score, n_bins).alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    bins = df.agg(F.count(F.lit(1)).alias("_n")).select(F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin"))
    return bins.join(counts, "bin", "left").select("bin", F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))


def minmax_score(df: DataFrame, score: str = "score", out: str = "score_scaled") -> DataFrame:
    """(s - min) / (max - min) for decision scores without probabilities."""
    lo = df.agg(F.min(score)).scalar()
    hi = df.agg(F.max(score)).scalar()
    return df.withColumn(out, F.try_divide(F.col(score) - lo, hi - lo))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, f1, support per class, then accuracy, macro and weighted averages.

    Built from the confusion counts (one ``groupBy``); 0/0 gives 0.
    """
    conf = df.groupBy(F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    support = conf.groupBy(F.col("y").alias("class")).agg(F.sum("n").alias("support"))
    predicted = conf.groupBy(F.col("p").alias("class")).agg(F.sum("n").alias("predicted"))
    tp = conf.where(F.col("y") == F.col("p")).select(F.col("y").alias("class"), F.col("n").alias("tp"))
    per = (support.join(predicted, "class", "full").join(tp, "class", "left")
                  .fillna(0, subset=["support", "predicted", "tp"]))
    prec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("support")), F.lit(0.0))
    per = per.withColumn("precision", prec).withColumn("recall", rec).withColumn(
        "f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
                         F.lit(0.0)))
    total = per.agg(F.sum("support")).scalar()
    rows = per.select("class", "precision", "recall",
                      "f1", F.col("support").cast("bigint").alias("support"))
    acc = per.agg(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                  F.lit(None).cast("double").alias("recall"),
                  (F.sum("tp") / total).alias("f1"), F.lit(total).cast("bigint").alias("support"))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.lit(total).cast("bigint").alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * F.col("support")) / total).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / total).alias("recall"),
                       (F.sum(F.col("f1") * F.col("support")) / total).alias("f1"),
                       F.lit(total).cast("bigint").alias("support"))
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted)
