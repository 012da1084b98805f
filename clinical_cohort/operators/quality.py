"""Data profiling and quality checks (Q1-Q13).

Sketch-sized metrics of a profile are aggregate expressions of **one
aggregation over one scan**; the single result row is turned into long form
with ``inline``. Exact distinct counts and quantiles need the values: they,
and with them the rest of an exact profile, are read off one table of
(column, value, count) that a single partial aggregation makes
(``value_counts``): rows are never expanded once per distinct count, and no
task gathers all values of a column - quantiles are picked by rank, with
prefix sums over buckets of values.
Distributions and contingency tables are ``groupBy`` over an exploded
``(Column, Value)`` pair - partial aggregation keeps the shuffle to one row
per distinct value per task. Results are typed (BIGINT counts, DOUBLE
percentages rounded to 6 places); ``percent_text`` gives the reference's
``"17.5%"`` strings when wanted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DateType, DoubleType, FloatType, MapType, NullType,
                               NumericType, StringType, StructType, TimestampNTZType, TimestampType)

from ..functions.stats import chi2_pvalue, t_pvalue

QUANTILES = (0.25, 0.5, 0.75)


def _pct(num: Column, den: Column) -> Column:
    """num * 100 / den as DOUBLE; null for den = 0."""
    return F.try_divide(num.cast("double") * F.lit(100.0), den.cast("double"))


def percent_text(c: Column) -> Column:
    """Percentage as text with a '%' sign (Spark's double formatting)."""
    return F.concat(c.cast("string"), F.lit("%"))


def _empty(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c).cast("string") == F.lit(""))


def _long(row: DataFrame, structs: list[Column]) -> DataFrame:
    return row.select(F.inline(F.array(*structs)))


def null_percentage(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q1: null-or-empty share per column -> (Column, NullCount, RowCount, NullPercentage).

    Empty text counts as missing; numbers are compared as text so the test
    is valid for every type under ANSI mode (D8).
    """
    cols = list(cols or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(_empty(c)).alias(f"_n{i}") for i, c in enumerate(cols)])
    out = _long(row, [F.struct(F.lit(c).alias("Column"), F.col(f"_n{i}").alias("NullCount"),
                               F.col("_rows").alias("RowCount")) for i, c in enumerate(cols)])
    return out.withColumn("NullPercentage", _pct(F.col("NullCount"), F.col("RowCount")))


def value_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(Column, Value, Num, Count): every distinct value of every column once, null and empty text too.

    Value is the value as text, by which values are told apart (-0.0 is 0.0,
    nested values as JSON); Num is a numeric value as DOUBLE, else null.
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    pairs = []
    for c in cols or df.columns:
        kind, x = types[c], F.col(c)
        if isinstance(kind, (DoubleType, FloatType)):
            text = (x.cast("double") + F.lit(0.0)).cast("string")
        elif isinstance(kind, (ArrayType, MapType, StructType)):
            text = F.when(x.isNotNull(), F.to_json(F.struct(x)))
        elif isinstance(kind, BinaryType):
            text = F.hex(x)
        else:
            text = x.cast("string")
        num = x.cast("double") if isinstance(kind, NumericType) else F.lit(None).cast("double")
        pairs.append(F.struct(F.lit(c).alias("Column"), text.alias("Value"), num.alias("Num")))
    return (df.select(F.inline(F.array(*pairs))).groupBy("Column", "Value")
            .agg(F.min("Num").alias("Num"), F.count(F.lit(1)).alias("Count")))


def _named(counts: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column name, for columns of which an empty frame has no value."""
    return counts.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, cols))).alias("Column"))


def exact_quantiles(counts: DataFrame, quantiles: Sequence[float] = QUANTILES, n_buckets: int = 128,
                    more: Sequence[Column] = ()) -> DataFrame:
    """(Column, n, mean, stddev, min, max, q0, q1, ..., *more) of the Num of ``value_counts``, by rank selection.

    A row for every column; ``more`` are further aggregates of its value
    counts. Quantiles interpolate linearly between the values at the ranks
    around q * (n - 1). Sketched quantiles of the distinct values cut each
    column into buckets; running sums of the buckets' counts (a few rows per
    column) tell which buckets hold a wanted rank, and only their values are
    sorted, each bucket by itself. The cuts decide about the buckets' sizes
    alone: any cuts give the same result. Every step starts at the shuffled
    value counts, so the rows are scanned once (the exchange is reused).
    """
    probs = F.array(*[F.lit(i / n_buckets) for i in range(1, max(n_buckets, 2))])
    own = F.when(F.col("Num").isNotNull(), F.col("Count"))
    stats = counts.groupBy("Column").agg(
        F.sum(own).alias("n"), F.try_divide(F.sum(F.col("Num") * F.col("Count")), F.sum(own)).alias("mean"),
        F.min("Num").alias("min"), F.max("Num").alias("max"), F.percentile_approx("Num", probs, F.lit(1000)).alias("cuts"), *more)
    placed = counts.where(F.col("Num").isNotNull()).select("Column", "Num", "Count").join(
        F.broadcast(stats.select("Column", "n", "mean", "cuts")), "Column").select(
        "Column", "Num", "Count", "n", (F.col("Count") * F.pow(F.col("Num") - F.col("mean"), 2)).alias("dev"),
        F.size(F.filter("cuts", lambda x: x < F.col("Num"))).alias("b"))
    sizes = placed.groupBy("Column", "b").agg(F.sum("Count").alias("k"), F.sum("dev").alias("dev"), F.max("n").alias("n"))
    up = Window.partitionBy("Column").orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = Window.partitionBy("Column")
    sizes = sizes.withColumn("end", F.sum("k").over(up)).withColumn("dev", F.sum("dev").over(total))
    wanted = [r for q in quantiles for r in (F.floor(F.lit(q) * (F.col("n") - 1)), F.ceil(F.lit(q) * (F.col("n") - 1)))]
    held = reduce(lambda x, y: x | y, [(r >= F.col("end") - F.col("k")) & (r < F.col("end")) for r in wanted])
    chosen = sizes.where(held).select("Column", "b", "dev", (F.col("end") - F.col("k")).alias("before"))
    inside = Window.partitionBy("Column", "b").orderBy("Num").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.drop("dev").join(F.broadcast(chosen), ["Column", "b"]).withColumn("last", F.col("before") + F.sum("Count").over(inside))
    at = [F.max(F.when((r >= F.col("last") - F.col("Count")) & (r < F.col("last")), F.col("Num"))).alias(f"_v{i}")
          for i, r in enumerate(wanted)]
    picked = ranked.groupBy("Column").agg(F.max("dev").alias("_dev"), *at)
    out = stats.drop("cuts").join(F.broadcast(picked), "Column", "left")
    position = [F.lit(q) * (F.col("n") - 1) for q in quantiles]
    values = [(F.col(f"_v{2 * i}") + (F.col(f"_v{2 * i + 1}") - F.col(f"_v{2 * i}")) * (x - F.floor(x))).alias(f"q{i}")
              for i, x in enumerate(position)]
    kept = [c for c in stats.columns if c not in ("Column", "n", "mean", "min", "max", "cuts")]
    return out.select("Column", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), "mean",
                      F.when(F.col("n") > 1, F.sqrt(F.col("_dev") / (F.col("n") - 1))).alias("stddev"), "min", "max", *values, *kept)


def numeric_summary(df: DataFrame, cols: Sequence[str], exact: bool = False, accuracy: int = 10000) -> DataFrame:
    """Q2: count, mean, sample stddev, min, quartiles, max per numeric column.

    ``exact=False`` (default) uses ``percentile_approx`` - a bounded sketch
    per task - in one aggregation of the rows. ``exact=True`` interpolates
    like SQL ``quantile_cont`` and works on the distinct values
    (``exact_quantiles``); columns may have any number of them.
    """
    if exact:
        found = exact_quantiles(value_counts(df.select(*[F.col(c).cast("double").alias(c) for c in cols]), cols))
        return _named(found, cols).join(F.broadcast(found), "Column", "left").select(
            "Column", F.coalesce("n", F.lit(0)).cast("bigint").alias("count"), "mean", "stddev", "min",
            F.col("q0").alias("p25"), F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max")
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"_c{i}"), F.avg(x).alias(f"_m{i}"), F.stddev_samp(x).alias(f"_s{i}"),
                 F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}")]
        aggs += [F.percentile_approx(x, F.lit(q), F.lit(accuracy)).alias(f"_q{i}_{j}") for j, q in enumerate(QUANTILES)]
    row = df.agg(*aggs)
    structs = []
    for i, c in enumerate(cols):
        structs.append(F.struct(
            F.lit(c).alias("Column"), F.col(f"_c{i}").alias("count"), F.col(f"_m{i}").alias("mean"),
            F.col(f"_s{i}").alias("stddev"), F.col(f"_lo{i}").alias("min"),
            F.col(f"_q{i}_0").alias("p25"), F.col(f"_q{i}_1").alias("p50"), F.col(f"_q{i}_2").alias("p75"),
            F.col(f"_hi{i}").alias("max")))
    return _long(row, structs)


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Q3: distinct values per column, null counted as one value -> (Column, DistinctCount)."""
    cols = list(cols or df.columns)
    if not approx:
        found = value_counts(df, cols).groupBy("Column").agg(F.count(F.lit(1)).alias("DistinctCount"))
        return _named(found, cols).join(F.broadcast(found), "Column", "left").select(
            "Column", F.coalesce("DistinctCount", F.lit(0).cast("bigint")).alias("DistinctCount"))
    row = df.agg(*[(F.approx_count_distinct(c) + F.max(F.when(F.col(c).isNull(), 1).otherwise(0))).cast("bigint").alias(f"_d{i}")
                   for i, c in enumerate(cols)])
    return _long(row, [F.struct(F.lit(c).alias("Column"), F.col(f"_d{i}").alias("DistinctCount"))
                       for i, c in enumerate(cols)])


def _cells(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(Column, Value) pairs, one per row and column, values as text."""
    pairs = F.array(*[F.struct(F.lit(c).alias("Column"), F.col(c).cast("string").alias("Value")) for c in cols])
    return df.select(F.inline(pairs))


def value_distribution(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q4: (Column, Value, Count) for every column; null is its own group.

    Sort with ``sampling.top_values`` when an ordered report is wanted (X1).
    """
    return _cells(df, cols).groupBy("Column", "Value").agg(F.count(F.lit(1)).alias("Count"))


def value_distribution_pct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q5: Q4 plus Percent of the column's rows.

    The per-column total is an aggregate of the (already reduced)
    distribution, joined back on ``Column`` (one row per column, broadcast).
    """
    dist = value_distribution(df, cols)
    totals = dist.groupBy("Column").agg(F.sum("Count").alias("_total"))
    return dist.join(totals, "Column").withColumn("Percent", _pct(F.col("Count"), F.col("_total"))).drop("_total")


def mismatch_percentage(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Q6: share of rows whose text does not match the regex.

    -> (Column, Pattern, MismatchCount, NullCount, RowCount, MismatchPercentage).
    Matching is unanchored (``rlike`` = find) unless the pattern anchors;
    nulls are not mismatches but stay in the denominator (D9).
    """
    items = list(patterns.items())
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (c, p) in enumerate(items):
        aggs.append(F.count_if(~F.col(c).cast("string").rlike(p)).alias(f"_m{i}"))
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"_n{i}"))
    row = df.agg(*aggs)
    out = _long(row, [F.struct(F.lit(c).alias("Column"), F.lit(p).alias("Pattern"),
                               F.col(f"_m{i}").alias("MismatchCount"), F.col(f"_n{i}").alias("NullCount"),
                               F.col("_rows").alias("RowCount")) for i, (c, p) in enumerate(items)])
    return out.withColumn("MismatchPercentage", _pct(F.col("MismatchCount"), F.col("RowCount")))


def column_kind(dtype) -> str:
    """Q7 kind of a Spark type (the reference's four plus date, boolean, nested)."""
    if isinstance(dtype, NumericType):
        return "numerical"
    if isinstance(dtype, StringType):
        return "string"
    if isinstance(dtype, NullType):
        return "null"
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return "time"
    if isinstance(dtype, DateType):
        return "date"
    if isinstance(dtype, BooleanType):
        return "boolean"
    if isinstance(dtype, (ArrayType, MapType, StructType)):
        return "nested"
    return "other"


def column_types(df: DataFrame, approx: bool = False) -> DataFrame:
    """Q7: (Column, Type, Kind, NonNullCount, DistinctCount), nulls in neither count.

    ``approx=True`` uses HyperLogLog++ sketches (one pass, fixed-size
    buffers) for very large tables.
    """
    fields = df.schema.fields
    kinds = [F.struct(F.lit(f.name).alias("Column"), F.lit(f.dataType.simpleString()).alias("Type"),
                      F.lit(column_kind(f.dataType)).alias("Kind")) for f in fields]
    if not approx:
        found = value_counts(df).where(F.col("Value").isNotNull()).groupBy("Column").agg(
            F.sum("Count").alias("NonNullCount"), F.count(F.lit(1)).alias("DistinctCount"))
        named = found.sparkSession.range(1).select(F.inline(F.array(*kinds)))
        return named.join(F.broadcast(found), "Column", "left").select("Column", "Type", "Kind", *[
            F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("NonNullCount", "DistinctCount")])
    aggs = []
    for i, f in enumerate(fields):
        aggs += [F.count(F.col(f.name)).alias(f"_c{i}"), F.approx_count_distinct(F.col(f.name)).alias(f"_d{i}")]
    row = df.agg(*aggs)
    return _long(row, [F.struct(k["Column"], k["Type"], k["Kind"], F.col(f"_c{i}").alias("NonNullCount"),
                                F.col(f"_d{i}").alias("DistinctCount")) for i, k in enumerate(kinds)])


def _moments(df: DataFrame, cols: Sequence[str], tag: str) -> DataFrame:
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"_n{i}"), F.avg(x).alias(f"_m{i}"), F.var_samp(x).alias(f"_v{i}"),
                 F.stddev_pop(x).alias(f"_s{i}")]
    row = df.agg(*aggs)
    return _long(row, [F.struct(F.lit(c).alias("Column"), F.col(f"_n{i}").alias(f"n{tag}"),
                                F.col(f"_m{i}").alias(f"mean{tag}"), F.col(f"_v{i}").alias(f"var{tag}"),
                                F.col(f"_s{i}").alias(f"std{tag}")) for i, c in enumerate(cols)])


def ttest_stats(main: DataFrame, sample: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q8: pooled two-sample t statistic per column, nulls dropped.

    -> (Column, n1, mean1, std1, n2, mean2, std2, t, dof); std is the
    population std the reference prints. t is null when a side has fewer
    than two values or the pooled variance is 0. One aggregation per frame.
    """
    a, b = _moments(main, cols, "1"), _moments(sample, cols, "2")
    j = a.join(b, "Column")
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    dof = n1 + n2 - F.lit(2.0)
    sp2 = ((n1 - 1) * F.col("var1") + (n2 - 1) * F.col("var2")) / dof
    ok = (F.col("n1") >= 2) & (F.col("n2") >= 2) & (sp2 > 0)
    t = F.when(ok, (F.col("mean1") - F.col("mean2")) / F.sqrt(sp2 * (F.lit(1.0) / n1 + F.lit(1.0) / n2)))
    return j.select("Column", "n1", "mean1", "std1",
                    "n2", "mean2", "std2",
                    t.alias("t"), F.when(ok, dof.cast("bigint")).alias("dof"))


def ttest(main: DataFrame, sample: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Q8 with the two-sided p-value (Arrow UDF on the per-column result)."""
    s = ttest_stats(main, sample, cols)
    return s.withColumn("p", t_pvalue(F.col("t"), F.col("dof")))


def contingency(main: DataFrame, sample: DataFrame, cols: Sequence[str] | str,
                categories: str = "main") -> DataFrame:
    """Q9: per column and category the count in main (Notes) and in sample (Rand).

    Categories are those of main (nulls dropped), as in the reference
    (D27); ``categories='union'`` also keeps categories seen only in the
    sample. Missing counts are 0.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    a = (_cells(main, cols).where(F.col("Value").isNotNull())
         .groupBy("Column", "Value").agg(F.count(F.lit(1)).alias("Notes")))
    b = (_cells(sample, cols).where(F.col("Value").isNotNull())
         .groupBy("Column", "Value").agg(F.count(F.lit(1)).alias("Rand")))
    how = "full" if categories == "union" else "left"
    return (a.join(b, ["Column", "Value"], how)
             .select("Column", "Value", F.coalesce("Notes", F.lit(0)).cast("bigint").alias("Notes"),
                     F.coalesce("Rand", F.lit(0)).cast("bigint").alias("Rand")))


def chisq_stats(table: DataFrame) -> DataFrame:
    """Q10: chi-square of a (Column, Value, Notes, Rand) table per Column.

    E = row total x column total / total; dof = categories - 1; Yates'
    continuity correction only when dof = 1; any expected count of 0 -> null.
    -> (Column, chi2, dof).
    """
    totals = table.groupBy("Column").agg(F.sum("Notes").alias("_c1"), F.sum("Rand").alias("_c2"),
                                         F.count(F.lit(1)).alias("_k"))
    t = table.join(totals, "Column")
    total = (F.col("_c1") + F.col("_c2")).cast("double")
    row = (F.col("Notes") + F.col("Rand")).cast("double")
    e1, e2 = row * F.col("_c1") / total, row * F.col("_c2") / total
    yates = F.col("_k") == 2

    def term(o, e):
        diff = F.abs(o.cast("double") - e)
        diff = F.when(yates, F.greatest(diff - F.lit(0.5), F.lit(0.0))).otherwise(diff)
        return F.try_divide(diff * diff, e)

    t = t.select("Column", "_k", (term(F.col("Notes"), e1) + term(F.col("Rand"), e2)).alias("_x"),
                 ((e1 == 0) | (e2 == 0) | e1.isNull() | e2.isNull()).alias("_zero"))
    agg = t.groupBy("Column").agg(F.sum("_x").alias("_chi2"), F.max("_zero").alias("_bad"), F.max("_k").alias("_k"))
    ok = ~F.col("_bad") & (F.col("_k") >= 2)
    return agg.select("Column", F.when(ok, F.col("_chi2")).alias("chi2"),
                      F.when(ok, (F.col("_k") - 1).cast("bigint")).alias("dof"))


def chisq(main: DataFrame, sample: DataFrame, cols: Sequence[str], categories: str = "main") -> DataFrame:
    """Q10 with the upper-tail p-value."""
    s = chisq_stats(contingency(main, sample, cols, categories))
    return s.withColumn("p", chi2_pvalue(F.col("chi2"), F.col("dof")))


def significance(p: str | Column) -> Column:
    """Q11: ns / * / ** / *** / **** ; null or NaN p -> null."""
    c = F.col(p) if isinstance(p, str) else p
    return (F.when(c.isNull() | F.isnan(c), F.lit(None).cast("string"))
             .when(c > 0.05, "ns").when(c < 1e-4, "****").when(c < 1e-3, "***").when(c < 1e-2, "**")
             .otherwise("*"))


def fdr_bh(tests: DataFrame, p: str = "p", n_buckets: int | None = None) -> DataFrame:
    """Q12: Benjamini-Hochberg adjusted p-values (``p_adj``).

    adj(i) = min over j >= i of p(j) * m / j, capped at 1, with i the rank
    of p ascending; null or NaN p stays null and does
    not count towards m.

    Inside a block of equal p-values p * m / j falls with j, so every member
    of the block gets the value at the block's last rank: the adjustment is
    a function of p alone and the tie order never changes it. The general
    path therefore works on the distinct p-values with their counts (one
    partially aggregated ``groupBy``, so a p-value shared by a third of all
    rows is one row per task): the last rank of each block is a running sum
    of counts, the adjustment a suffix minimum, both two-level over
    quantile buckets of p (``evaluation.value_buckets``), and the result is
    joined back to the rows on p.
    """
    from .evaluation import value_buckets

    ok = F.col(p).isNotNull() & ~F.isnan(p)
    valid = tests.where(ok)
    rest = tests.where(~ok | F.col(p).isNull()).withColumn("p_adj", F.lit(None).cast("double"))
    d = valid.groupBy(F.col(p).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    m = d.agg(F.sum("_c")).scalar()
    d = value_buckets(d, "_p", n_buckets)
    w_in = Window.partitionBy("_b").orderBy("_p")
    d = d.withColumn("_r", F.sum("_c").over(w_in.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    sizes = d.groupBy("_b").agg(F.sum("_c").alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    d = d.join(F.broadcast(offsets), "_b").withColumn("_raw", F.col("_p") * m / (F.col("_r") + F.col("_off")))
    d = d.withColumn("_tail", F.min("_raw").over(w_in.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    mins = d.groupBy("_b").agg(F.min("_raw").alias("_bmin"))
    after = Window.orderBy("_b").rowsBetween(1, Window.unboundedFollowing)
    later = mins.select("_b", F.min("_bmin").over(after).alias("_later"))
    adj = F.least(F.col("_tail"), F.coalesce(F.col("_later"), F.col("_tail")), F.lit(1.0))
    per_p = d.join(F.broadcast(later), "_b").select("_p", adj.alias("p_adj"))
    out = valid.join(per_p, valid[p] == per_p["_p"], "inner").select(*tests.columns, "p_adj")
    return out.unionByName(rest)


def profile(df: DataFrame, numeric: Sequence[str] = (), categorical: Sequence[str] = (),
            patterns: Mapping[str, str] | None = None, exact: bool = False,
            approx_distinct: bool = False) -> DataFrame:
    """Q13: every scalar profile metric -> (Column, Metric, Value).

    Metrics: rows, nulls, null_pct, distinct (all profiled columns); count,
    mean, stddev, min, p25, p50, p75, max (numeric); mismatch, mismatch_pct
    (regex columns). Split the long result by Metric for the separate reports.
    ``exact=True`` reads all of them off one table of value counts.
    ``exact=False`` sketches the quantiles, and with ``approx_distinct=True``
    the distinct counts too, which makes the profile one aggregation of the rows.
    """
    patterns = dict(patterns or {})
    allc = list(dict.fromkeys([*numeric, *categorical, *patterns]))
    if exact:
        return _exact_profile(df, allc, list(numeric), patterns)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(allc):
        aggs.append(F.count_if(_empty(c)).alias(f"_null{i}"))
        if approx_distinct:
            aggs.append((F.approx_count_distinct(F.col(c)) + F.max(F.when(F.col(c).isNull(), 1).otherwise(0))).alias(f"_dist{i}"))
    for i, c in enumerate(numeric):
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"_cnt{i}"), F.avg(x).alias(f"_mean{i}"), F.stddev_samp(x).alias(f"_std{i}"),
                 F.min(x).alias(f"_min{i}"), F.max(x).alias(f"_max{i}")]
        aggs += [F.percentile_approx(x, F.lit(q), F.lit(10000)).alias(f"_q{j}_{i}") for j, q in enumerate(QUANTILES)]
    for i, (c, pat) in enumerate(patterns.items()):
        aggs.append(F.count_if(~F.col(c).cast("string").rlike(pat)).alias(f"_mis{i}"))
    row = df.agg(*aggs)

    def s(col: str, metric: str, value: Column) -> Column:
        return F.struct(F.lit(col).alias("Column"), F.lit(metric).alias("Metric"),
                        value.cast("double").alias("Value"))

    rows = F.col("_rows")
    structs = [s("*", "rows", rows)]
    for i, c in enumerate(allc):
        structs += [s(c, "nulls", F.col(f"_null{i}")), s(c, "null_pct", _pct(F.col(f"_null{i}"), rows))]
        if approx_distinct:
            structs.append(s(c, "distinct", F.col(f"_dist{i}")))
    for i, c in enumerate(numeric):
        structs += [s(c, "count", F.col(f"_cnt{i}")), s(c, "mean", F.col(f"_mean{i}")),
                    s(c, "stddev", F.col(f"_std{i}")), s(c, "min", F.col(f"_min{i}")),
                    s(c, "p25", F.col(f"_q0_{i}")), s(c, "p50", F.col(f"_q1_{i}")), s(c, "p75", F.col(f"_q2_{i}")),
                    s(c, "max", F.col(f"_max{i}"))]
    for i, c in enumerate(patterns):
        structs += [s(c, "mismatch", F.col(f"_mis{i}")), s(c, "mismatch_pct", _pct(F.col(f"_mis{i}"), rows))]
    out = _long(row, structs)
    if not approx_distinct:
        out = out.unionByName(distinct_counts(df, allc).select(
            "Column", F.lit("distinct").alias("Metric"), F.col("DistinctCount").cast("double").alias("Value")))
    return out


def _exact_profile(df: DataFrame, cols: Sequence[str], numeric: Sequence[str], patterns: Mapping[str, str]) -> DataFrame:
    """The metrics of ``profile`` from the value counts of ``cols``; a pattern is tried once per distinct value."""
    counts = value_counts(df, cols)
    missing = F.col("Value").isNull() | (F.col("Value") == "")
    fails = F.lit(False)
    for c, p in patterns.items():
        fails = fails | ((F.col("Column") == c) & ~F.col("Value").rlike(p))
    per = exact_quantiles(counts, more=[
        F.sum("Count").alias("rows"), F.sum(F.when(missing, F.col("Count")).otherwise(0)).alias("nulls"),
        F.count(F.lit(1)).alias("distinct"), F.sum(F.when(fails, F.col("Count")).otherwise(0)).alias("mismatch")])
    zero = F.lit(0).cast("bigint")
    all_of = _named(counts, cols).join(F.broadcast(per), "Column", "left").withColumns(
        {c: F.coalesce(c, zero) for c in ("rows", "nulls", "distinct", "mismatch")})
    names = {"count": "n", "mean": "mean", "stddev": "stddev", "min": "min", "p25": "q0", "p50": "q1", "p75": "q2", "max": "max"}
    value = {"nulls": F.col("nulls"), "null_pct": _pct(F.col("nulls"), F.col("rows")), "distinct": F.col("distinct")}
    some = {}
    if numeric:
        some[tuple(numeric)] = {m: F.coalesce(c, zero) if m == "count" else F.col(c) for m, c in names.items()}
    if patterns:
        some[tuple(patterns)] = {"mismatch": F.col("mismatch"), "mismatch_pct": _pct(F.col("mismatch"), F.col("rows"))}
    metric = lambda m, v: F.struct(F.lit(m).alias("Metric"), v.cast("double").alias("Value"))
    none = F.array().cast("array<struct<Metric:string,Value:double>>")
    parts = [F.array(*[metric(m, v) for m, v in value.items()])]
    parts += [F.when(F.col("Column").isin(list(c)), F.array(*[metric(m, v) for m, v in of.items()])).otherwise(none)
              for c, of in some.items()]
    total = F.when(F.col("Column") == cols[0], F.array(metric("rows", F.col("rows")))).otherwise(none)
    made = all_of.select(F.col("Column").alias("_of"), F.size(total).alias("_first"), F.posexplode(F.concat(total, *parts)).alias("_i", "_m"))
    return made.select(F.when((F.col("_first") == 1) & (F.col("_i") == 0), "*").otherwise(F.col("_of")).alias("Column"), "_m.Metric", "_m.Value")
