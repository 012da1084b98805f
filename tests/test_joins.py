import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from clinical_cohort.operators import joins as J
from plan_text import plan_text


def _rows(df):
    return sorted(tuple("~" if v is None else str(v) for v in r) for r in df.collect())


def test_full_outer_matches_spark_full_join(spark):
    random.seed(1)
    left = [(random.choice([None, 1, 2, 3, 4]), f"l{i}") for i in range(30)]
    right = [(random.choice([None, 2, 3, 5, 6]), f"r{i}") for i in range(20)]
    a = spark.createDataFrame(left, "k long, lv string")
    b = spark.createDataFrame(right, "k long, rv string")
    ours = J.full_outer_join(a, b, "k").select("k", "lv", "rv")
    ref = a.join(b, "k", "full").select("k", "lv", "rv")
    assert _rows(ours) == _rows(ref)


def test_interval_join_last_day_rule(spark):
    visits = spark.createDataFrame([(1, 10, dt.datetime(2020, 3, 1), dt.datetime(2020, 12, 30, 8))],
                                   "person_id long, visit_occurrence_id long, visit_start_datetime timestamp_ntz, "
                                   "visit_end_datetime timestamp_ntz")
    periods = spark.createDataFrame([(1, dt.date(2020, 1, 1), dt.date(2020, 12, 30), "A", "B")],
                                    "person_id long, payer_plan_period_start_date date, "
                                    "payer_plan_period_end_date date, payer_source_value string, plan_source_value string")
    assert J.interval_join(visits, periods).count() == 1          # D4: compared as a date
    assert J.interval_join(visits, periods, strict=True).count() == 0
    assert "CartesianProduct" not in plan_text(J.interval_join(visits, periods))


def test_latest_per_key_joins_on_key_and_date(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1), "A"), (1, dt.date(2021, 1, 1), "B"),
                                (2, dt.date(2020, 1, 1), "C")], "person_id long, d date, v string")
    out = J.latest_per_key(df, "person_id", "d")
    assert sorted(r.v for r in out.collect()) == ["B", "C"]  # D2


def test_prior_visits_equals_pairwise_definition(spark):
    random.seed(3)
    rows = [(i, random.randint(1, 4), dt.datetime(2020, 1, 1) + dt.timedelta(days=random.randint(0, 50)))
            for i in range(40)]
    visits = spark.createDataFrame(rows, "visit_occurrence_id long, person_id long, visit_end_datetime timestamp_ntz")
    index_ids = [r[0] for r in rows if r[0] % 5 == 0]
    index = spark.createDataFrame([(i,) for i in index_ids], "visit_occurrence_id long")
    got = {(r.person_id, r.visit_occurrence_id) for r in J.prior_visits(visits, index).collect()}
    want = {(b[1], b[0]) for a in rows if a[0] in index_ids for b in rows if b[1] == a[1] and b[2] <= a[2]}
    assert got == want
    assert "CartesianProduct" not in plan_text(J.prior_visits(visits, index))


def test_active_at_visit_open_ended(spark):
    cond = spark.createDataFrame([(1, dt.datetime(2020, 1, 1), None), (1, dt.datetime(2020, 1, 1), dt.datetime(2020, 3, 1))],
                                 "visit_occurrence_id long, condition_start_datetime timestamp_ntz, "
                                 "condition_end_datetime timestamp_ntz")
    visits = spark.createDataFrame([(1, 7, dt.datetime(2020, 2, 1))],
                                   "visit_occurrence_id long, person_id long, visit_start_datetime timestamp_ntz")
    assert J.active_at_visit(cond, visits).count() == 1
    assert J.active_at_visit(cond, visits, open_ended=True).count() == 2


def test_join_all_prefixes_clashing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k long, name string")
    b = spark.createDataFrame([(1, "y")], "k long, name string")
    c = spark.createDataFrame([(1,)], "other long")
    out = J.join_all({"a": a, "b": b, "c": c}, "k")
    assert sorted(out.columns) == ["a_name", "b_name", "k"]


def test_interval_join_bins_equal_plain_join_and_brute_force(spark):
    random.seed(7)
    base = dt.datetime(2019, 1, 1)
    visits = []
    for i in range(300):
        start = base + dt.timedelta(days=random.randint(0, 900), hours=random.randint(0, 23))
        end = start + dt.timedelta(hours=random.randint(-400, 400))  # some end before their start
        if i % 37 == 0:
            end = None
        visits.append((random.choice([1, 1, 1, 2, 3]), i, start, end))
    periods = []
    for j in range(60):
        s = dt.date(2018, 6, 1) + dt.timedelta(days=random.randint(0, 1100))
        e = s + dt.timedelta(days=random.randint(-30, 400))  # some inverted periods
        if j % 13 == 0:
            e = dt.date(2099, 12, 31)  # open-ended coverage
        if j % 17 == 0:
            s = dt.date(1900, 1, 1)
        periods.append((random.choice([1, 1, 2, 3, 4]), s, e, f"P{j}", "x"))
    v = spark.createDataFrame(visits, "person_id long, visit_occurrence_id long, visit_start_datetime timestamp_ntz, "
                                      "visit_end_datetime timestamp_ntz")
    p = spark.createDataFrame(periods, "person_id long, payer_plan_period_start_date date, "
                                       "payer_plan_period_end_date date, payer_source_value string, "
                                       "plan_source_value string")
    for strict in (False, True):
        want = set()
        for pid, vid, s, e in visits:
            for qid, ps, pe, name, _ in periods:
                if e is None or pid != qid:
                    continue
                end_ok = (e <= dt.datetime.combine(pe, dt.time())) if strict else (e.date() <= pe)
                if s >= dt.datetime.combine(ps, dt.time()) and end_ok:
                    want.add((vid, name))
        for bins in (91, 7, None):
            got = J.interval_join(v, p, strict=strict, bin_days=bins).select("visit_occurrence_id",
                                                                              "payer_source_value")
            rows = [(r[0], r[1]) for r in got.collect()]
            assert len(rows) == len(set(rows))
            assert set(rows) == want
    plan = plan_text(J.interval_join(v, p))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # The equi key carries the time bin, so a hot person is split across bins.
    join_line = next(line for line in plan.splitlines() if "HashJoin" in line or "SortMergeJoin" in line)
    assert join_line.count("_bin") >= 2


def test_full_outer_many_matches_chained_full_joins(spark):
    random.seed(12)
    frames = []
    for t in range(4):
        rows = [(random.choice([None, 1, 2, 3, 4, 5, 6]), random.choice([None, "x", "y"]), f"t{t}r{i}")
                for i in range(random.randint(0, 12))]
        frames.append(spark.createDataFrame(rows, f"k long, k2 string, v{t} string"))
    for on in ("k", ["k", "k2"]):
        fs = frames if on != "k" else [f.drop("k2") if i else f for i, f in enumerate(frames)]
        ours = J.join_frames(fs, on, "full")
        ref = fs[0]
        for f in fs[1:]:
            ref = ref.join(f, on, "full")
        cols = ref.columns
        assert ours.columns == cols
        assert _rows(ours.select(*cols)) == _rows(ref)
    plan = plan_text(J.join_frames([f.drop("k2") for f in frames], "k", "full"))
    assert plan.count("Scan") <= 3 * len(frames)  # linear in the number of frames


def test_join_paths_and_tables_from_a_folder(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], "k long, x string").write.parquet(str(tmp_path / "one"))
    spark.createDataFrame([(2, 20), (3, 30)], "k long, y int").write.parquet(str(tmp_path / "two"))
    spark.createDataFrame([(9,)], "other long").write.parquet(str(tmp_path / "three"))
    left = J.join_paths(spark, [str(tmp_path / "one"), str(tmp_path / "two")], "k")
    assert {tuple(r) for r in left.collect()} == {(1, "a", None), (2, "b", 20)}
    full = J.join_tables_with(spark, str(tmp_path), "k", ["one", "two", "three"])
    assert {tuple(r) for r in full.select("k", "x", "y").collect()} == {(1, "a", None), (2, "b", 20), (3, None, 30)}


def test_interval_join_without_valid_events_makes_no_bins(spark):
    events = spark.createDataFrame([(1, None, None)], "person_id long, visit_start_datetime timestamp_ntz, "
                                   "visit_end_datetime timestamp_ntz")
    periods = spark.sql("SELECT 1L AS person_id, DATE'0001-01-01' AS payer_plan_period_start_date, "
                        "DATE'9999-12-31' AS payer_plan_period_end_date")
    assert J.interval_join(events, periods).collect() == []


@pytest.mark.parametrize("open_ended", [False, True])
@pytest.mark.parametrize("bin_days", [1, 30, 5000])
def test_conditions_of_the_person_match_brute_force(spark, open_ended, bin_days):
    import random
    random.seed(3)
    day = lambda lo, hi: dt.datetime(2020, 1, 1) + dt.timedelta(days=random.randint(lo, hi), hours=random.choice([0, 0, 5]))
    visits = [(v, random.choice([1, 1, 1, 2, 3, None]), random.choice([day(0, 400), None, day(0, 400)])) for v in range(60)]
    conditions = []
    for c in range(120):
        start = random.choice([day(-300, 500), day(-300, 500), None])
        end = random.choice([None, dt.datetime(2999, 1, 1), (start or day(0, 1)) + dt.timedelta(days=random.randint(-3, 90))])
        conditions.append((random.randint(0, 70), random.choice([1, 1, 2, 4, None]), c, start, end))
    vf = spark.createDataFrame(visits, "visit_occurrence_id long, person_id long, visit_start_datetime timestamp_ntz")
    cf = spark.createDataFrame(conditions, "visit_occurrence_id long, person_id long, code int, condition_start_datetime timestamp_ntz, "
                                           "condition_end_datetime timestamp_ntz")
    got = J.active_at_visit(cf, vf, scope="person", open_ended=open_ended, bin_days=bin_days)
    want = sorted((c[2], c[0], v[0]) for c in conditions for v in visits
                  if c[1] is not None and c[1] == v[1] and c[3] and v[2] and c[3] < v[2] and (c[4] > v[2] if c[4] else open_ended))
    assert sorted((r.code, r.recorded_visit_id, r.visit_occurrence_id) for r in got.collect()) == want and want
    plan = plan_text(got)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "_bin" in plan
