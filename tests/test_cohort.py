import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from clinical_cohort.operators.filters import CohortFilter
from clinical_cohort.plans.cohort import CohortTables, demographic_pull


def _tables(spark):
    person = spark.createDataFrame(
        [(1, dt.date(1950, 6, 1), None, "Male", "r", "e", 10, 100), (2, dt.date(1980, 1, 1), dt.date(2020, 1, 1),
                                                                      "Female", "r", "e", 11, 101)],
        "person_id long, birth_datetime date, death_datetime date, gender_source_value string, race_source_value string, "
        "ethnicity_source_value string, care_site_id long, location_id long")
    visits = spark.createDataFrame(
        [(1, 1, dt.datetime(2000, 7, 1), dt.datetime(2000, 7, 2)), (1, 2, dt.datetime(2010, 7, 1), dt.datetime(2010, 7, 1, 5))],
        "person_id long, visit_occurrence_id long, visit_start_datetime timestamp_ntz, visit_end_datetime timestamp_ntz")
    payer = spark.createDataFrame([(1, dt.date(2000, 1, 1), dt.date(2000, 12, 31), "P1", "Plan1"),
                                   (1, dt.date(2010, 1, 1), dt.date(2010, 12, 31), "P2", "Plan2")],
                                  "person_id long, payer_plan_period_start_date date, payer_plan_period_end_date date, "
                                  "payer_source_value string, plan_source_value string")
    site = spark.createDataFrame([(10, "Site A"), (12, "Orphan site")], "care_site_id long, care_site_name string")
    loc = spark.createDataFrame([(100, "NY")], "location_id long, state string")
    return CohortTables(person, visits, payer, site, loc)


def test_age_per_visit_and_insurance(spark):
    main, sample = demographic_pull(_tables(spark), "visit_occurrence_id")
    rows = {r.visit_occurrence_id: r for r in main.collect()}
    assert rows[1].age == 50 and rows[2].age == 60          # D1: one age per visit
    assert rows[1].plan_source_value == "Plan1" and rows[2].plan_source_value == "Plan2"
    assert rows[1].visit_length == 86400
    assert rows[None].care_site_name in ("Orphan site", None)  # D16 orphans kept
    assert sample.count() == main.count()                       # n = 0 -> whole frame


def test_person_grain_and_filters(spark):
    main, _ = demographic_pull(_tables(spark), "person_id", as_of="2024-01-01")
    ages = {r.person_id: r.age for r in main.collect() if r.person_id is not None}
    assert ages == {1: 73, 2: 40}                                # D15 as_of, death
    filtered, _ = demographic_pull(_tables(spark), "visit_occurrence_id", CohortFilter(age=[55, 65]))
    assert [r.visit_occurrence_id for r in filtered.collect()] == [2]


def test_bad_grain_raises(spark):
    with pytest.raises(ValueError):
        demographic_pull(_tables(spark), "care_site_id")


def test_orphan_sites_and_locations_match_plain_full_joins(spark):
    import random
    random.seed(4)
    people = [(p, dt.date(1960, 1, 1), None, "Male", "r", "e", random.choice([None, 1, 2, 3]),
               random.choice([None, 7, 8])) for p in range(1, 30)]
    person = spark.createDataFrame(people, _tables(spark).person.schema)
    visits = spark.createDataFrame(
        [(random.choice([None, *range(1, 40)]), v, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 2))
         for v in range(60)],
        "person_id long, visit_occurrence_id long, visit_start_datetime timestamp_ntz, visit_end_datetime timestamp_ntz")
    payer = _tables(spark).payer_plan_period.limit(0)
    site = spark.createDataFrame([(1, "a"), (2, "b"), (4, "orphan"), (5, "orphan2")], "care_site_id long, care_site_name string")
    loc = spark.createDataFrame([(7, "NY"), (9, "orphan")], "location_id long, state string")
    main, _ = demographic_pull(CohortTables(person, visits, payer, site, loc), "visit_occurrence_id")
    cols = ["person_id", "visit_occurrence_id", "care_site_id", "care_site_name", "location_id", "state"]
    ref = (visits.join(person, "person_id", "full").join(site, "care_site_id", "full")
                 .join(loc, "location_id", "full"))

    def rows(df):
        return sorted(tuple("~" if v is None else str(v) for v in r) for r in df.select(*cols).collect())

    assert rows(main) == rows(ref)


def test_cohort_from_omop_folders(spark, tmp_path):
    t = _tables(spark)
    site = t.care_site.selectExpr("*", "99L AS location_id", "1L AS place_of_service_concept_id")
    for name, df in (("person", t.person.withColumnRenamed("x", "y")), ("visit_occurrence", t.visit_occurrence),
                     ("payer_plan_period", t.payer_plan_period), ("care_site", site), ("location", t.location)):
        df.write.parquet(str(tmp_path / name))
    loaded = CohortTables.from_folder(spark, str(tmp_path))
    for grain in ("visit_occurrence_id", "person_id"):
        main, _ = demographic_pull(loaded, grain, as_of="2024-01-01")
        want, _ = demographic_pull(t, grain, as_of="2024-01-01")
        assert main.columns == want.columns
        assert sorted(map(str, main.collect())) == sorted(map(str, want.collect()))


def test_first_target_of_tied_rows_does_not_depend_on_order(spark):
    from clinical_cohort.sources.files import load_targets
    rows = [(1, dt.date(2020, 1, 1), "yes"), (1, dt.date(2020, 1, 1), "no"), (1, dt.date(2019, 1, 1), None)]
    for r in (rows, rows[::-1]):
        df = spark.createDataFrame(r, "k long, at date, y string").coalesce(1)
        assert [tuple(x) for x in load_targets(df, "k", "at").collect()] == [(1, 0)]


def _frames(spark, visits, people=(), payers=(), sites=(), locations=()):
    return CohortTables(
        spark.createDataFrame(list(people), "person_id long, birth_datetime timestamp_ntz, death_datetime timestamp_ntz, gender_source_value string, "
                              "race_source_value string, ethnicity_source_value string, care_site_id long, location_id long"),
        spark.createDataFrame(list(visits), "person_id long, visit_occurrence_id long, visit_start_datetime timestamp_ntz, "
                              "visit_end_datetime timestamp_ntz, care_site_id long"),
        spark.createDataFrame(list(payers), "person_id long, payer_plan_period_start_date date, payer_plan_period_end_date date, "
                              "payer_source_value string, plan_source_value string"),
        spark.createDataFrame(list(sites), "care_site_id long, care_site_name string, location_id long"),
        spark.createDataFrame(list(locations), "location_id long, state string"))


def test_one_row_per_person_and_sites_of_the_visit(spark):
    t0 = dt.datetime(2020, 1, 1)
    person = lambda i, site, loc: (i, dt.datetime(1980, 1, 1), None, "F", "r", "e", site, loc)
    day = dt.date(2020, 1, 1)
    tables = _frames(
        spark, [(1, 10, t0, t0 + dt.timedelta(hours=2), 7), (1, 11, t0 + dt.timedelta(days=3), t0 + dt.timedelta(days=3, hours=1), None),
                (2, 20, t0, None, 8), (9, 90, t0, t0, 99)],
        [person(1, 8, 4), person(2, None, 5), person(3, 7, None)],
        [(1, day, dt.date(2020, 12, 31), "b", "x"), (1, day, dt.date(2020, 6, 30), "a", "y"), (3, day, day, "c", None)],
        [(7, "seven", 4), (8, "eight", 5), (6, "six", 3)], [(3, "S3"), (4, "S4"), (5, "S5"), (2, "S2")])
    one = {r.person_id: r for r in demographic_pull(tables, "person_id", how="left", one_row_per_person=True)[0].collect()}
    assert set(one) == {1, 2, 3, 9}
    assert (one[1].n_visits, one[1].total_visit_length, one[1].payer_source_value, one[1].care_site_name, one[1].state) == (2, 10_800, "a", "eight", "S4")
    assert one[1].first_visit_start == t0 and one[1].last_visit_start == t0 + dt.timedelta(days=3)
    assert (one[2].n_visits, one[2].total_visit_length) == (1, None) and (one[3].n_visits, one[3].payer_source_value) == (0, "c")
    full = demographic_pull(tables, "person_id", one_row_per_person=True)[0].collect()
    assert sorted(r.care_site_name for r in full if r.person_id is None and r.care_site_name) == ["six"]

    of_visit = {r.visit_occurrence_id: r for r in demographic_pull(tables, site_from="visit", how="left")[0].collect()}
    assert (of_visit[10].care_site_name, of_visit[10].state) == ("seven", "S4") and of_visit[20].state == "S5"
    assert of_visit[11].care_site_name is None and of_visit[90].care_site_id == 99 and of_visit[90].care_site_name is None
    orphans = [(r.care_site_name, r.state) for r in demographic_pull(tables, site_from="visit")[0].collect()
               if r.person_id is None]
    assert sorted(orphans, key=str) == [("six", "S3"), (None, "S2")]
    with pytest.raises(ValueError):
        demographic_pull(tables, one_row_per_person=True)


def test_combined_keeps_people_without_a_visit_out_of_the_join(spark):
    from clinical_cohort.plans.cohort import _left_by_visit
    left = spark.createDataFrame([(None, 1), (None, 2), (5, 3), (6, 4)], "visit_occurrence_id long, p long")
    right = spark.createDataFrame([(None, "x"), (5, "y"), (5, "z")], "visit_occurrence_id long, m string")
    assert sorted((tuple(r) for r in _left_by_visit(left, right).collect()), key=str) == [
        (5, 3, "y"), (5, 3, "z"), (6, 4, None), (None, 1, None), (None, 2, None)]


def test_optional_folder_is_an_empty_typed_table(spark, tmp_path):
    tables = _frames(spark, [], [(1, None, None, "F", "r", "e", None, None)])
    for name in ("person", "visit_occurrence", "care_site", "location"):
        getattr(tables, name).write.parquet(str(tmp_path / name))
    with pytest.raises(AnalysisException):
        CohortTables.from_folder(spark, str(tmp_path))
    read = CohortTables.from_folder(spark, str(tmp_path), optional=["payer_plan_period"])
    rows = demographic_pull(read)[0].collect()
    assert [(r.person_id, r.payer_source_value) for r in rows] == [(1, None)]
