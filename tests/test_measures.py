import datetime as dt

from clinical_cohort.operators import measures as M
from plan_text import plan_text

T = dt.datetime(2020, 1, 1)


def _frame(spark):
    rows = [(None, "HR", T, 5.0), (1, "HR", T, 5.0), (1, "HR", T, 7.0), (1, "HR", T + dt.timedelta(hours=1), 9.0)]
    return spark.createDataFrame(rows, "visit_occurrence_id long, measurement_source_value string, "
                                       "measurement_datetime timestamp_ntz, value_as_number double")


def test_one_row_per_group_with_ties_and_null_key(spark):
    out = {r.visit_occurrence_id: r for r in M.measurement_summary(_frame(spark)).collect()}
    assert set(out) == {None, 1}                      # D7: null key is one group
    r = out[1]
    assert (r.Max_value, r.Min_value, r.Mean_value) == (9.0, 5.0, 7.0)
    assert r.First_Datetime == T and r.First_Value == 5.0   # D6: tie broken by smallest value
    assert r.Last_Value == 9.0 and r.First_Datetime <= r.Last_Datetime


def test_ties_long_form(spark):
    rows = M.measurement_first_last_ties(_frame(spark)).collect()
    firsts = sorted(r.Value for r in rows if r.visit_occurrence_id == 1 and r.position == "first")
    lasts = [r.Value for r in rows if r.visit_occurrence_id == 1 and r.position == "last"]
    assert firsts == [5.0, 7.0] and lasts == [9.0]


def test_single_shuffle_plan(spark):
    df = M.measurement_summary(_frame(spark))
    df.collect()
    plan = plan_text(df)
    assert plan.count("Exchange hashpartitioning") + plan.count("ShuffleQueryStage") >= 1
    assert plan.count("Exchange hashpartitioning") <= 1 and plan.count("ShuffleQueryStage") <= 1
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan


def test_code_filter_and_decode(spark):
    m = spark.createDataFrame([(1, 3025315, "w", T, 1.0), (1, 99, "x", T, 2.0)],
                              "visit_occurrence_id long, measurement_concept_id long, measurement_source_value string, "
                              "measurement_datetime timestamp_ntz, value_as_number double")
    c = spark.createDataFrame([(3025315, "Body weight"), (99, "other")], "concept_id long, concept_name string")
    out = M.measurement_pull(m, c).collect()
    assert [r.measurement_source_value for r in out] == ["w"]
