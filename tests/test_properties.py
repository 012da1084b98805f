"""Property tests (hypothesis) on small generated frames."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clinical_cohort.operators import features as FE
from clinical_cohort.operators import filters as FL
from clinical_cohort.operators import measures as M
from clinical_cohort.operators import quality as Q
from clinical_cohort.operators import sampling as S

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(1, 4)), st.sampled_from(["A", "B", None]),
              st.integers(0, 1000), st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False))),
    min_size=0, max_size=40)


def _measure_frame(spark, rows):
    t0 = dt.datetime(2020, 1, 1)
    data = [(k, s, t0 + dt.timedelta(minutes=m), v) for k, s, m, v in rows]
    return spark.createDataFrame(data, "visit_occurrence_id long, measurement_source_value string, "
                                       "measurement_datetime timestamp_ntz, value_as_number double")


@SETTINGS
@given(rows=rows_strategy)
def test_summary_invariants(spark, rows):
    out = M.measurement_summary(_measure_frame(spark, rows)).collect()
    keys = {(k, s) for k, s, _, _ in rows}
    assert len(out) == len(keys)
    for r in out:
        if r.Max_value is not None:
            assert r.Min_value <= r.Max_value
            assert r.Min_value - 1e-6 <= r.Mean_value <= r.Max_value + 1e-6
        assert r.First_Datetime <= r.Last_Datetime


@SETTINGS
@given(rows=rows_strategy)
def test_null_pct_bounds_and_filter_partition(spark, rows):
    df = _measure_frame(spark, rows)
    for r in Q.null_percentage(df).collect():
        assert r.NullPercentage is None or 0.0 <= r.NullPercentage <= 100.0
    a = FL.filter_in(df, "measurement_source_value", ["A"]).count()
    b = FL.filter_not_in(df, "measurement_source_value", ["A"], keep_null=True).count()
    assert a + b == len(rows)


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(1, 5), st.sampled_from(["x", "y", "z.1", "w w"])), max_size=30))
def test_pivot_sum_equals_long_count(spark, pairs):
    df = spark.createDataFrame(pairs, "visit_occurrence_id long, c string") if pairs else \
        spark.createDataFrame([], "visit_occurrence_id long, c string")
    long_df = FE.category_counts(df, "c", "P_")
    names = sorted({r.feature for r in long_df.collect()})
    if not names:
        return
    wide = FE.to_wide(long_df, names).collect()
    assert sum(sum(r[n] for n in names) for r in wide) == len(pairs)


@SETTINGS
@given(n=st.integers(1, 300), seed=st.integers(0, 1000))
def test_split_parts_disjoint_and_cover(spark, n, seed):
    df = spark.range(n).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    s = S.stratified_split(df, "y", ["id"], seed=seed)
    got = s.groupBy("split").count().collect()
    assert sum(r["count"] for r in got) == n
    assert {r.split for r in got} <= {"train", "validation", "test"}
