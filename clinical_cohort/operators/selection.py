"""Feature selection on the long feature table.

The feature table is long ``(key, feature, value)`` with non-zero values
only; labels are ``(key, label)``. Scores are per-feature aggregations after
one join of features with labels - the implicit zeros of a sparse matrix
never have to be materialised.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import rank_features


def chi2_scores(features: DataFrame, labels: DataFrame, key: str = "visit_occurrence_id",
                label: str = "label", classes: Sequence[int] = (0, 1)) -> DataFrame:
    """L1: chi-square score of each non-negative feature against the label.

    O(c, f) = sum of the feature over rows of class c; E(c, f) = share(c) x
    sum of the feature; score = sum over classes of (O - E)^2 / E. Class
    shares are scalar subqueries over the label table. A feature that is
    zero everywhere has no row (and would score null). -> (feature, score).
    """
    n = labels.agg(F.count(F.lit(1))).scalar()
    shares = {c: F.try_divide(labels.agg(F.count_if(F.col(label) == F.lit(c))).scalar().cast("double"), n)
              for c in classes}
    j = features.join(labels.select(key, label), key, "inner")
    aggs = [F.sum("value").cast("double").alias("_t")]
    aggs += [F.sum(F.when(F.col(label) == F.lit(c), F.col("value")).otherwise(0)).cast("double").alias(f"_o{i}")
             for i, c in enumerate(classes)]
    per = j.groupBy("feature").agg(*aggs)
    terms = []
    for i, c in enumerate(classes):
        e = shares[c] * F.col("_t")
        terms.append(F.try_divide(F.pow(F.col(f"_o{i}") - e, 2), e))
    score = reduce(lambda a, b: a + b, terms)
    return per.select("feature", score.alias("score"))


def chi2_scores_by_target(features: DataFrame, targets: DataFrame, columns: Sequence[str],
                          key: str = "visit_occurrence_id") -> DataFrame:
    """Chi-square scores of every feature against every 0/1 target column, in one pass over the features.

    One join brings a row's targets to its features and one aggregate sums
    each feature over all rows and over the positive rows of each target; the
    class shares are one aggregate of the targets, used as a scalar subquery.
    -> (target, feature, score).
    """
    shares = targets.agg(F.struct(F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c)).alias(f"p{i}") for i, c in enumerate(columns)])).scalar()
    labels = targets.select(key, *[F.col(c).alias(f"_l{i}") for i, c in enumerate(columns)])
    sums = features.join(labels, key).groupBy("feature").agg(
        F.sum("value").cast("double").alias("_t"),
        *[F.sum(F.when(F.col(f"_l{i}") == 1, F.col("value")).otherwise(0)).cast("double").alias(f"_o{i}") for i in range(len(columns))])
    sums = sums.withColumn("_s", shares)

    def score(i: int):
        one = F.try_divide(F.col(f"_s.p{i}").cast("double"), F.col("_s.n"))
        terms = [F.try_divide(F.pow(o - share * F.col("_t"), 2), share * F.col("_t"))
                 for o, share in ((F.col("_t") - F.col(f"_o{i}"), 1 - one), (F.col(f"_o{i}"), one))]
        return terms[0] + terms[1]

    return sums.select("feature", F.inline(F.array(*[
        F.struct(F.lit(c).alias("target"), score(i).alias("score")) for i, c in enumerate(columns)]))).select("target", "feature", "score")


def top_k_by_target(scores: DataFrame, k: int) -> DataFrame:
    """The k best features of each target (nulls last, ties by name) -> (target, feature, score, rank)."""
    from pyspark.sql import Window
    w = Window.partitionBy("target").orderBy(F.col("score").desc_nulls_last(), F.col("feature").asc())
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(scores: DataFrame, k: int, score: str = "score", feature: str = "feature") -> DataFrame:
    """The k best features by score (nulls last), ties by name; -> (feature, rank)."""
    from pyspark.sql import Window
    w = Window.orderBy(F.col(score).desc_nulls_last(), F.col(feature).asc())
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(feature, "rank")


def support_scores(features: DataFrame) -> DataFrame:
    """Number of rows in which each feature is present -> (feature, score)."""
    return features.groupBy("feature").agg(F.count(F.lit(1)).cast("double").alias("score"))


def minmax_features(features: DataFrame, n_rows: int | F.Column | None = None,
                    keys: DataFrame | None = None, key: str = "visit_occurrence_id") -> DataFrame:
    """L2: per-feature min and max over all rows, absent entries counting as 0.

    The row count is a scalar subquery over ``keys`` (or the distinct keys of
    ``features``): a feature present in fewer rows than that has min 0.
    -> (feature, min_value, max_value).
    """
    if n_rows is None:
        base = keys.select(key) if keys is not None else features.select(key)
        n_rows = base.distinct().agg(F.count(F.lit(1))).scalar()
    per = features.groupBy("feature").agg(F.min("value").cast("double").alias("_mn"),
                                          F.max("value").cast("double").alias("_mx"),
                                          F.count(F.lit(1)).alias("_n"))
    mn = F.when(F.col("_n") < n_rows, F.least(F.col("_mn"), F.lit(0.0))).otherwise(F.col("_mn"))
    mx = F.when(F.col("_n") < n_rows, F.greatest(F.col("_mx"), F.lit(0.0))).otherwise(F.col("_mx"))
    return per.select("feature", mn.alias("min_value"), mx.alias("max_value"))


def minmax_scale(features: DataFrame, ranges: DataFrame) -> DataFrame:
    """L2 applied: (x - min) / (max - min) for the stored entries (0 when max = min)."""
    j = features.join(ranges, "feature", "inner")
    scaled = F.coalesce(F.try_divide(F.col("value") - F.col("min_value"), F.col("max_value") - F.col("min_value")),
                        F.lit(0.0))
    return j.select(*[c for c in features.columns if c != "value"], scaled.alias("value"))


def vote_table(selected: Mapping[str, DataFrame], n: int | None = None, feature: str = "feature") -> DataFrame:
    """One 0/1 column per selector, ``Total``, ranked by Total then Feature (both desc).

    ``selected`` maps a selector name to a frame of selected feature names.
    The flags come from one ``groupBy`` over the union of the selections.
    """
    names = list(selected)
    union = reduce(lambda a, b: a.unionByName(b), [
        df.select(F.col(feature).alias("Feature"), F.lit(name).alias("_sel")) for name, df in selected.items()])
    votes = union.groupBy("Feature").agg(
        *[F.max(F.when(F.col("_sel") == name, 1).otherwise(0)).cast("int").alias(name) for name in names])
    votes = votes.withColumn("Total", reduce(lambda a, b: a + b, [F.col(c) for c in names]).cast("int"))
    if n is None:
        return votes
    return rank_features(votes, n)


def votes_by_target(selections: Mapping[str, Mapping[str, DataFrame]], n: int | None = None) -> DataFrame:
    """L7 for every target: ``selections[target][selector]`` are frames of feature names -> vote tables with a target column."""
    tables = [vote_table(by, n).select(F.lit(t).alias("target"), "*") for t, by in selections.items()]
    return reduce(lambda a, b: a.unionByName(b), tables)
