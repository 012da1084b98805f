"""Exact isotonic calibration of scores.

The best increasing fit to 0/1 labels by score: neighbouring scores whose
shares of positives do not increase are pooled until all do. Pooling may be
done in any order with the same result, so each range of scores pools its own
first; then the pools of 16 neighbouring ranges are pooled together, and so on
until one group is left. Counts are whole numbers and shares are compared by
cross products, so nothing is rounded.

The last group is small whatever the data: its pools have different shares
of positives, and there are only so many fractions with small denominators -
n rows give at most about n^(2/3) of them (a thousand for 30 000 rows, whatever
the scores), which is also what a task ever holds besides its own range.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .evaluation import distinct_scores, value_buckets

_FAN = 16
_POOLS = "_b long, lo double, hi double, pos long, n long"
_FITTED = "lo double, hi double, pos long, n long, value double, next_lo double, next_value double"


def pooled(rows: list[tuple[float, float, int, int]]) -> list[tuple[float, float, int, int]]:
    """Adjacent violators pooled: (lo, hi, positives, rows) by score, shares strictly increasing in the result."""
    out: list[tuple[float, float, int, int]] = []
    for lo, hi, pos, n in rows:
        while out and out[-1][2] * n >= pos * out[-1][3]:
            before = out.pop()
            lo, pos, n = before[0], before[2] + pos, before[3] + n
        out.append((lo, hi, pos, n))
    return out


def _pool(group: pd.DataFrame) -> list[tuple[float, float, int, int]]:
    ordered = group.sort_values("lo")
    return pooled(list(zip(*(ordered[c].tolist() for c in ("lo", "hi", "pos", "n")), strict=True)))


def isotonic_fit(df: DataFrame, score: str = "score", label: str = "label", n_buckets: int | None = None) -> DataFrame:
    """(lo, hi, pos, n, value, next_lo, next_value): one row per pool, value its share of positives.

    Rows without a score or label are left out.
    """
    def pool(group: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(_pool(group), columns=["lo", "hi", "pos", "n"])
        out.insert(0, "_b", group["_b"].iloc[0])
        return out

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(_pool(group), columns=["lo", "hi", "pos", "n"])
        out["value"] = out["pos"] / out["n"]
        out["next_lo"], out["next_value"] = out["lo"].shift(-1), out["value"].shift(-1)
        return out

    n_buckets = n_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = distinct_scores(df.where(F.col(score).isNotNull()), score, label)
    pools = value_buckets(d, "score", n_buckets).select(
        F.col("_b").cast("long").alias("_b"), F.col("score").alias("lo"), F.col("score").alias("hi"), "pos",
        (F.col("pos") + F.col("neg")).alias("n"))
    left = n_buckets + 1
    while left > 1:
        pools = pools.groupBy("_b").applyInPandas(pool, _POOLS).withColumn("_b", F.floor(F.col("_b") / _FAN))
        left = -(-left // _FAN)
    return pools.groupBy("_b").applyInPandas(finish, _FITTED)


def isotonic_apply(df: DataFrame, fitted: DataFrame, score: str = "score", out: str = "isotonic",
                   n_buckets: int | None = None) -> DataFrame:
    """``df`` with ``out``: the value of the pool that holds the score; between two pools linear, beyond the first
    and last their value. Null scores stay null.

    Each distinct score takes the last pool that starts at or below it: pools and
    scores are laid side by side in ranges of scores, a window finds the last
    pool inside a range, and a few rows per range carry the last pool of those before.
    """
    scores = df.select(F.col(score).cast("double").alias("s")).where(F.col("s").isNotNull()).distinct()
    pool = F.struct("hi", "value", "next_lo", "next_value")
    both = scores.select("s", F.lit(1).alias("kind"), F.lit(None).cast("struct<hi:double,value:double,next_lo:double,next_value:double>").alias("p")).unionByName(
        fitted.select(F.col("lo").alias("s"), F.lit(0).alias("kind"), pool.alias("p")))
    both = value_buckets(both, "s", n_buckets)
    inside = Window.partitionBy("_b").orderBy("s", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = both.where("kind = 0").groupBy("_b").agg(F.max_by("p", "s").alias("end"))
    every = both.select("_b").distinct().join(ends, "_b", "left")  # a row for each range
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select("_b", F.last("end", ignorenulls=True).over(before).alias("carry"))
    first = fitted.agg(F.min_by("value", "lo")).scalar()
    met = both.withColumn("p", F.last("p", ignorenulls=True).over(inside)).where("kind = 1").join(F.broadcast(carried), "_b").select(
        "s", F.coalesce("p", "carry").alias("p"))
    between = F.col("p.value") + (F.col("p.next_value") - F.col("p.value")) * (F.col("s") - F.col("p.hi")) / (F.col("p.next_lo") - F.col("p.hi"))
    value = (F.when(F.col("p").isNull(), first).when((F.col("s") <= F.col("p.hi")) | F.col("p.next_lo").isNull(), F.col("p.value"))
             .otherwise(between))
    valued = met.select(F.col("s").alias("_s"), value.alias(out))
    return df.join(valued, df[score].cast("double") == valued["_s"], "left").drop("_s")
