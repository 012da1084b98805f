"""Sorts, limits, samples, unions.

Every limit here has a total order, so the same rows come back on every run
and in every engine; none of them pulls data to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seeded_hash(keys: Sequence[str], seed: int = 42) -> Column:
    """md5 of the key text and the seed: same order in Spark and in SQL engines."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def comparison_sample(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42,
                      tiebreak: Sequence[str] | None = None) -> DataFrame:
    """Deterministic pseudo-random bottom-k by seeded hash; n=0 -> whole frame.

    Plans as ``TakeOrderedAndProject``: each task keeps its own k smallest
    rows and only those k x tasks rows are merged, so the cost is one scan.
    """
    if n <= 0:
        return df
    order = [seeded_hash(keys, seed)] + [F.col(c).asc_nulls_first() for c in (tiebreak or keys)]
    return df.orderBy(*order).limit(n)


def top_values(df: DataFrame, count_col: str = "Count", value_col: str = "Value") -> DataFrame:
    """Sort by count descending, value ascending as tie rule."""
    return df.orderBy(F.col(count_col).desc(), F.col(value_col).asc_nulls_first())


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union of same-schema frames by column name."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_all needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames[1:], frames[0])


def rank_features(votes: DataFrame, n: int, total: str = "Total", feature: str = "Feature") -> DataFrame:
    """Top-n features by votes then name (both descending), numbered from 1.

    ``row_number() <= n`` over a window lets Spark insert a group limit
    below the exchange (``WindowGroupLimit``), so each task forwards at most
    n rows to the final ranking.
    """
    w = Window.orderBy(F.col(total).desc(), F.col(feature).desc())
    return votes.withColumn("Rank", F.row_number().over(w)).where(F.col("Rank") <= n)


def best_features(scores: DataFrame, n: int, target: str = "target", score: str = "score",
                  feature: str = "feature", exclude_like: str | None = "person_id") -> DataFrame:
    """Top-n features per target; names containing ``exclude_like`` are dropped.

    Same group-limit plan as ``rank_features``, partitioned by target.
    """
    if exclude_like:
        scores = scores.where(~F.col(feature).contains(exclude_like))
    w = Window.partitionBy(target).orderBy(F.col(score).desc_nulls_last(), F.col(feature).desc())
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def stratified_split(df: DataFrame, label: str, keys: Sequence[str], fractions=(0.8, 0.1, 0.1),
                     seed: int = 42, ranges: int = 4096) -> DataFrame:
    """Assign ``split`` in {train, validation, test}, with each class cut in the same shares.

    Within a class rows are ranked by a seeded hash of their key (ties by the
    key); the first round(n * a) go to train, up to round(n * (a + b)) to
    validation. Ranks need no sort of a whole class: rows are counted per class
    and hash range (a small table), a range before a cut belongs to one split
    as a whole, and only the two ranges that hold a cut are ranked row by row.
    """
    h = seeded_hash(keys, seed)
    rows = df.withColumn("_h", h).withColumn(
        "_r", F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("double") * ranges / 2.0 ** 32).cast("int"))
    counts = rows.groupBy(F.col(label).alias("_c"), F.col("_r").alias("_r2")).agg(F.count(F.lit(1)).alias("_n"))
    by_class = Window.partitionBy("_c")
    sums = (counts.withColumn("_before", F.sum("_n").over(by_class.orderBy("_r2")) - F.col("_n"))
                  .withColumn("_total", F.sum("_n").over(by_class)))
    a, b = fractions[0], fractions[0] + fractions[1]
    cuts = sums.withColumn("_a", F.round(F.col("_total") * F.lit(a))).withColumn("_b", F.round(F.col("_total") * F.lit(b)))
    end = F.col("_before") + F.col("_n")

    def holds(cut: str):
        return (F.col("_before") < F.col(cut)) & (F.col(cut) < end)

    cuts = cuts.withColumn("_cut", holds("_a") | holds("_b"))
    placed = rows.join(cuts, rows[label].eqNullSafe(cuts["_c"]) & (rows["_r"] == cuts["_r2"]))
    order = [F.col("_h"), *[F.col(k) for k in keys]]
    split = lambda rank: (F.when(rank <= F.col("_a"), "train").when(rank <= F.col("_b"), "validation")
                          .otherwise("test"))
    whole = placed.where(~F.col("_cut")).select(*df.columns, split(end).alias("split"))
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_c", "_r").orderBy(*order))
    inside = placed.where("_cut").withColumn("_rank", rank).select(*df.columns, split(F.col("_rank")).alias("split"))
    return whole.unionByName(inside)
