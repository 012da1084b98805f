import datetime as dt

import pytest
from pyspark.sql import functions as F

from clinical_cohort.operators import filters as FL


def test_numeric_range_point_and_nulls(spark):
    df = spark.createDataFrame([(1,), (5,), (10,), (None,)], "x int")
    assert sorted(r.x for r in FL.filter_numeric(df, "x", [1, 5]).collect()) == [1, 5]
    assert [r.x for r in FL.filter_numeric(df, "x", [10]).collect()] == [10]
    # three values: equality with the first
    assert [r.x for r in FL.filter_numeric(df, "x", [5, 1, 10]).collect()] == [5]
    assert FL.filter_numeric(df, "x", []).count() == 4


def test_filter_in_bare_string_and_not_in(spark):
    df = spark.createDataFrame([("Male",), ("M",), (None,), ("",)], "g string")
    assert [r.g for r in FL.filter_in(df, "g", "Male").collect()] == ["Male"]
    kept = FL.filter_not_in(df, "g", ["Male"], keep_null=True).collect()
    assert sorted((r.g is None, r.g) for r in kept) == [(False, ""), (False, "M"), (True, None)]
    dropped = FL.filter_not_in(df, "g", ["Male"]).collect()
    assert sorted(r.g for r in dropped) == ["", "M"]
    # F2 and F3(keep_null) partition the input
    assert FL.filter_in(df, "g", ["Male"]).count() + len(kept) == df.count()


def test_filter_datetime_and_map(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1), "a", "x"), (dt.datetime(2021, 6, 1), "b", "y")],
                               "t timestamp_ntz, c string, d string")
    assert FL.filter_datetime(df, "t", [dt.datetime(2019, 1, 1), dt.datetime(2020, 12, 31)]).count() == 1
    assert FL.filter_by_map(df, {"c": ["a", "b"], "d": "y"}).count() == 1


def test_cohort_filter_empty_means_no_filter(spark):
    df = spark.createDataFrame([(40, "Male")], "age int, gender_source_value string")
    assert FL.apply_cohort_filters(df, FL.CohortFilter()).count() == 1
    assert FL.apply_cohort_filters(df, FL.CohortFilter(age=[50, 60])).count() == 0


def test_flag_text_and_boolean(spark):
    df = spark.createDataFrame([("True", True), ("False", False), ("true", None)], "s string, b boolean")
    assert FL.filter_flag(df, "s", True).count() == 2
    assert FL.filter_flag(df, "b", False).count() == 1


def test_clean_columns_and_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b c` int, `x(y)` int")
    assert FL.clean_columns(df, "P_").columns == ["P_a_bc", "P_xy"]
    clash = spark.createDataFrame([(1, 2)], "`A.B` int, `A_B` int")
    with pytest.raises(ValueError):
        FL.clean_columns(clash)


def test_fill_zero_leaves_timestamps(spark):
    df = spark.createDataFrame([(None, None, None)], "n int, d double, t timestamp_ntz")
    row = FL.fill_zero(df).collect()[0]
    assert row.n == 0 and row.d == 0.0 and row.t is None


def test_restrict_to_is_semi_join(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    ids = spark.createDataFrame([(1,), (1,)], "k long")
    out = FL.restrict_to(df, ids, "k")
    assert sorted(r.v for r in out.collect()) == ["a", "b"]  # no duplication from repeated ids


def test_filter_since_start(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 1)),
                                (dt.datetime(2020, 1, 1), dt.datetime(2019, 12, 31))],
                               "s timestamp_ntz, e timestamp_ntz")
    assert FL.filter_since_start(df, "e", "s", 3600).count() == 1
