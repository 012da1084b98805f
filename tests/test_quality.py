import math
import random

import pytest
from pyspark.sql import functions as F

from clinical_cohort.functions import stats
from clinical_cohort.operators import quality as Q

PATTERNS = {"age": "^[0-99]{1,2}$", "first_name": "^[a-zA-Z]*$", "gender": "^M(ale)?$|^F(emale)?$"}


def _golden(spark):
    """40 rows shaped like the reference's worked profile example."""
    rows = []
    for i in range(40):
        age = None if i < 8 else (-21 if i == 8 else 155 if i == 9 else 100 if i == 10 else 20 + i)
        city = None if 10 <= i < 17 else f"City{i % 9}"
        state = None if i in (20, 21) else f"S{i % 26}"
        gender = "X" if i in (30, 31) else ("Male" if i % 2 else "F")
        rows.append((i, f"Name{chr(65 + i % 26)}", gender, age, city, state, 1000 * i))
    return spark.createDataFrame(rows, "id int, first_name string, gender string, age int, city string, "
                                       "state string, income int")


def test_golden_null_and_mismatch_percentages(spark):
    df = _golden(spark)
    nulls = {r.Column: r.NullPercentage for r in Q.null_percentage(df).collect()}
    assert nulls["age"] == 20.0 and nulls["city"] == 17.5 and nulls["state"] == 5.0 and nulls["gender"] == 0.0
    mism = {r.Column: r.MismatchPercentage for r in Q.mismatch_percentage(df, PATTERNS).collect()}
    assert mism == {"age": 7.5, "first_name": 0.0, "gender": 5.0}
    summ = {r.Column: r for r in Q.numeric_summary(df, ["age", "income"], exact=True).collect()}
    assert summ["age"]["count"] == 32 and summ["age"]["min"] == -21 and summ["age"]["max"] == 155
    assert summ["income"]["count"] == 40


def test_profile_is_one_job_and_consistent(spark):
    df = _golden(spark)
    prof = Q.profile(df, ["age"], ["city"], PATTERNS, exact=True)
    got = {(r.Column, r.Metric): r.Value for r in prof.collect()}
    assert got[("age", "null_pct")] == 20.0 and got[("age", "count")] == 32
    assert got[("gender", "mismatch_pct")] == 5.0 and got[("*", "rows")] == 40
    assert 0 <= got[("city", "null_pct")] <= 100


def test_empty_frame_and_numeric_empty_rule(spark):
    df = spark.createDataFrame([], "x int")
    r = Q.null_percentage(df).collect()[0]
    assert r.RowCount == 0 and r.NullPercentage is None         # D10
    df2 = spark.createDataFrame([(1,), (None,)], "x int")
    assert Q.null_percentage(df2).collect()[0].NullCount == 1   # D8: no ANSI error


def test_distinct_counts_null_is_a_value(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    assert Q.distinct_counts(df).collect()[0].DistinctCount == 3


@pytest.mark.parametrize("p,stars", [(0.06, "ns"), (0.05, "*"), (0.02, "*"), (0.005, "**"), (0.0005, "***"),
                                     (0.00005, "****"), (None, None)])
def test_significance(spark, p, stars):
    df = spark.createDataFrame([(p,)], "p double")
    assert df.select(Q.significance("p").alias("s")).collect()[0].s == stars


def test_fdr_matches_brute_force(spark):
    random.seed(7)
    ps = [random.random() ** 2 for _ in range(25)]
    df = spark.createDataFrame([(f"c{i}", p) for i, p in enumerate(ps)], "Column string, p double")
    got = {r.Column: r.p_adj for r in Q.fdr_bh(df).collect()}
    order = sorted(range(len(ps)), key=lambda i: (ps[i], f"c{i}"))
    m = len(ps)
    for rank, i in enumerate(order, start=1):
        want = min(1.0, min(ps[j] * m / (k + 1) for k, j in enumerate(order) if k + 1 >= rank))
        assert math.isclose(got[f"c{i}"], want, rel_tol=1e-12)


@pytest.mark.parametrize("n_buckets", [1, 2, 3, 16])
def test_fdr_buckets_ties_and_missing(spark, n_buckets):
    random.seed(5)
    ps = [round(random.random() ** 3, 2) for _ in range(300)]  # many ties
    ps[7], ps[8], ps[9] = None, float("nan"), None
    df = spark.createDataFrame([(i, p) for i, p in enumerate(ps)], "id long, p double")
    got = {r.id: r.p_adj for r in Q.fdr_bh(df, n_buckets=n_buckets).collect()}
    assert len(got) == len(ps)
    valid = [i for i, p in enumerate(ps) if p is not None and not math.isnan(p)]
    order = sorted(valid, key=lambda i: (ps[i], i))
    m = len(order)
    suffix, want = float("inf"), {}
    for rank in range(m, 0, -1):
        i = order[rank - 1]
        suffix = min(suffix, ps[i] * m / rank)
        want[i] = min(1.0, suffix)
    for i in range(len(ps)):
        if i in want:
            assert math.isclose(got[i], want[i], rel_tol=1e-12)
        else:
            assert got[i] is None


def test_pvalue_helpers_against_table_values():
    assert math.isclose(stats.t_sf_two_sided(2.0, 10), 0.07338803, rel_tol=1e-6)
    assert math.isclose(stats.chi2_sf(3.841458820694124, 1), 0.05, rel_tol=1e-6)
    assert math.isclose(stats.chi2_sf(10.0, 4), 0.040427681994512805, rel_tol=1e-9)


def test_ttest_and_chisq_formulas(spark):
    a = spark.createDataFrame([(float(x), "u" if x % 3 else "v") for x in range(1, 21)], "x double, c string")
    b = spark.createDataFrame([(float(x), "u" if x % 2 else "v") for x in range(5, 15)], "x double, c string")
    t = Q.ttest(a, b, ["x"]).collect()[0]
    xs, ys = list(range(1, 21)), list(range(5, 15))
    m1, m2 = sum(xs) / 20, sum(ys) / 10
    v1 = sum((x - m1) ** 2 for x in xs) / 19
    v2 = sum((y - m2) ** 2 for y in ys) / 9
    sp2 = (19 * v1 + 9 * v2) / 28
    assert math.isclose(t.t, round((m1 - m2) / math.sqrt(sp2 * (1 / 20 + 1 / 10)), 6), abs_tol=1e-6)
    assert t.dof == 28 and 0 <= t.p <= 1
    c = Q.chisq(a, b, ["c"]).collect()[0]
    # 2x2 table -> Yates correction
    cats = ['u', 'v']
    obs = [[sum(1 for x in xs if (('u' if x % 3 else 'v') == k)), sum(1 for y in ys if (('u' if y % 2 else 'v') == k))]
           for k in cats]
    tot = sum(map(sum, obs))
    rows = [sum(r) for r in obs]
    cols = [obs[0][0] + obs[1][0], obs[0][1] + obs[1][1]]
    chi = sum((max(0, abs(obs[i][j] - rows[i] * cols[j] / tot) - 0.5)) ** 2 / (rows[i] * cols[j] / tot)
              for i in range(2) for j in range(2))
    assert c.dof == 1 and math.isclose(c.chi2, round(chi, 6), abs_tol=1e-6)


def test_exact_quantiles_match_brute_force(spark):
    """Skewed, tied, missing and special values; any number of buckets."""
    random.seed(21)
    nan = float("nan")
    a = [random.choice([random.gauss(1e9, 3.0), 7.25, -0.0, 0.0, None]) for _ in range(999)]
    b = [random.choice([1, 2, 3]) for _ in range(999)]
    df = spark.createDataFrame([(x, y, nan, None, float(i % 7 == 0)) for i, (x, y) in enumerate(zip(a, b))],
                               "a double, b int, c double, d long, e double").repartition(5)
    for n_buckets in (1, 2, 7, 300):
        got = {r.Column: r for r in Q.exact_quantiles(Q.value_counts(df), n_buckets=n_buckets).collect()}
        for name, values in (("a", a), ("b", b)):
            x = sorted(v for v in values if v is not None)
            r = got[name]
            mean = sum(x) / len(x)
            assert r.n == len(x) and math.isclose(r.mean, mean, rel_tol=1e-12) and (r.min, r.max) == (x[0], x[-1])
            assert math.isclose(r.stddev, math.sqrt(sum((v - mean) ** 2 for v in x) / (len(x) - 1)), rel_tol=1e-9)
            for q, v in zip(Q.QUANTILES, (r.q0, r.q1, r.q2)):
                at = q * (len(x) - 1)
                lo, hi = x[math.floor(at)], x[math.ceil(at)]
                assert math.isclose(v, lo + (hi - lo) * (at - math.floor(at)), rel_tol=1e-12, abs_tol=1e-12)
        assert math.isnan(got["c"].q1) and got["d"].n == 0 and got["d"].q1 is None and (got["e"].q0, got["e"].q2) == (0.0, 0.0)
    summary = {r.Column: r for r in Q.numeric_summary(df, ["b", "d"], exact=True).collect()}
    assert summary["d"]["count"] == 0 and summary["d"].p50 is None and summary["b"]["count"] == 999
    distinct = {r.Column: r.DistinctCount for r in Q.distinct_counts(df).collect()}
    assert distinct == {"a": len({v if v is None else v + 0.0 for v in a}), "b": 3, "c": 1, "d": 1, "e": 2}


def test_value_counts_of_other_types(spark):
    df = spark.createDataFrame([([1, 2], bytearray(b"\xff"), "x"), ([1], bytearray(b"\xfe"), ""), (None, None, None), ([1], None, "x")],
                               "n array<int>, b binary, s string")
    got = {r.Column: r.DistinctCount for r in Q.distinct_counts(df).collect()}
    assert got == {"n": 3, "b": 3, "s": 3}
    types = {r.Column: (r.NonNullCount, r.DistinctCount) for r in Q.column_types(df).collect()}
    assert types == {"n": (3, 2), "b": (2, 2), "s": (3, 2)}


def test_exact_profile_reads_one_scan_and_expands_no_row(spark, tmp_path):
    spark.range(1000).selectExpr("id AS k", "CAST(id % 7 AS STRING) AS c", "id % 3 AS m").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    profile = Q.profile(df, ["k", "m"], ["c"], {"c": "^[0-5]$"}, exact=True)
    got = {(r.Column, r.Metric): r.Value for r in profile.collect()}
    assert got[("k", "p50")] == 499.5 and got[("c", "distinct")] == 7 and got[("c", "mismatch")] == 142 and got[("*", "rows")] == 1000
    for df2 in (profile, Q.numeric_summary(df, ["k", "m"], exact=True), Q.distinct_counts(df), Q.column_types(df)):
        plan = df2._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "percentile(" not in plan
    empty = {(r.Column, r.Metric): r.Value for r in Q.profile(df.limit(0), ["k"], ["c"], {"c": "x"}, exact=True).collect()}
    assert empty[("*", "rows")] == 0 and empty[("k", "count")] == 0 and empty[("k", "p50")] is None and empty[("c", "null_pct")] is None
    loose = {(r.Column, r.Metric) for r in Q.profile(df, ["k", "m"], ["c"], {"c": "^[0-5]$"}).collect()}
    assert loose == set(got)
