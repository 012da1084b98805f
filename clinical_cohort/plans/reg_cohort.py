"""Registered queries: measurements, joins, cohort jobs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import measures as M
from ..operators.filters import CohortFilter
from ..operators.sampling import comparison_sample
from .cohort import CohortTables, cohort_combined, demographic_pull
from .registry import ORACLES, register
from .roles import Roles, cte

VISIT_KEYS = ["visit_occurrence_id", "measurement_source_value"]

# Concept sets used by the registered pulls (selected through vocabulary
# attributes, so the whole measurement table is read and joined).
VITALS_VOCAB = "STANDARD"
LABS_VOCAB = "ECONOMY"
COHORT_AGE = [30, 50]  # the combined workflow's default age filter


def _tables(r: Roles) -> CohortTables:
    return CohortTables(r.person, r.visit_occurrence, r.payer_plan_period, r.care_site, r.location)


_MEASURE_AGGS = """
  max(value_as_number) AS Max_value, min(value_as_number) AS Min_value,
  round(avg(value_as_number), 6) AS Mean_value,
  min(measurement_datetime) AS First_Datetime,
  arg_min(value_as_number, row(measurement_datetime, value_as_number)) AS First_Value,
  max(measurement_datetime) AS Last_Datetime,
  arg_max(value_as_number, row(measurement_datetime, value_as_number)) AS Last_Value"""


@register("measure_first_last", cte("measurement", "concept") + f"""
SELECT m.visit_occurrence_id, m.measurement_source_value, {_MEASURE_AGGS}
FROM measurement m JOIN concept c ON m.measurement_concept_id = c.concept_id
GROUP BY 1, 2""", digits=6)
def q_measure_first_last(spark, sf):
    r = Roles(spark, sf)
    return M.measurement_pull(r.measurement, r.concept, codes=None)


@register("measure_summary", cte("measurement") + """
SELECT visit_occurrence_id, measurement_source_value,
  max(value_as_number) AS Max_value, min(value_as_number) AS Min_value,
  round(avg(value_as_number), 6) AS Mean_value
FROM measurement GROUP BY 1, 2""", digits=6)
def q_measure_summary(spark, sf):
    r = Roles(spark, sf)
    return M.measurement_summary(r.measurement, first_last=False)


def _pull_sql(vocab: str) -> str:
    return cte("measurement", "concept") + f"""
SELECT m.visit_occurrence_id, m.measurement_source_value, {_MEASURE_AGGS}
FROM measurement m JOIN concept c ON m.measurement_concept_id = c.concept_id
WHERE c.vocabulary_id = '{vocab}'
GROUP BY 1, 2"""


@register("measurement_pull", _pull_sql(VITALS_VOCAB), digits=6)
def q_measurement_pull(spark, sf):
    r = Roles(spark, sf)
    return M.measurement_pull(r.measurement, r.concept, codes=None,
                              concept_filter=F.col("vocabulary_id") == VITALS_VOCAB)


@register("lab_pull", _pull_sql(LABS_VOCAB), digits=6)
def q_lab_pull(spark, sf):
    r = Roles(spark, sf)
    return M.measurement_pull(r.measurement, r.concept, codes=None,
                              concept_filter=F.col("vocabulary_id") == LABS_VOCAB)


_SOME_CODES = "measurement_concept_id % 7 = 3 AND measurement_concept_id < 200"


@register("measurement_pull_codes", cte("measurement", "concept") + f"""
SELECT m.visit_occurrence_id, m.measurement_source_value, {_MEASURE_AGGS}
FROM measurement m JOIN concept c ON m.measurement_concept_id = c.concept_id
WHERE {_SOME_CODES} GROUP BY 1, 2""", digits=6)
def q_measurement_pull_codes(spark, sf):
    """the pull for an explicit list of concept codes."""
    r = Roles(spark, sf)
    return M.measurement_pull(r.measurement, r.concept, codes=[c for c in range(200) if c % 7 == 3])


@register("measure_first_last_ties", cte("measurement") + """
, b AS (SELECT visit_occurrence_id, measurement_source_value,
          min(measurement_datetime) AS f, max(measurement_datetime) AS l
        FROM measurement GROUP BY 1, 2)
SELECT m.visit_occurrence_id, m.measurement_source_value, 'first' AS position,
       m.measurement_datetime AS Datetime, m.value_as_number AS Value
FROM measurement m JOIN b ON m.visit_occurrence_id IS NOT DISTINCT FROM b.visit_occurrence_id
  AND m.measurement_source_value IS NOT DISTINCT FROM b.measurement_source_value AND m.measurement_datetime = b.f
UNION ALL
SELECT m.visit_occurrence_id, m.measurement_source_value, 'last' AS position,
       m.measurement_datetime, m.value_as_number
FROM measurement m JOIN b ON m.visit_occurrence_id IS NOT DISTINCT FROM b.visit_occurrence_id
  AND m.measurement_source_value IS NOT DISTINCT FROM b.measurement_source_value AND m.measurement_datetime = b.l""")
def q_measure_first_last_ties(spark, sf):
    r = Roles(spark, sf)
    return M.measurement_first_last_ties(r.measurement)


_SAMPLE_HASH = "md5(concat_ws('|', coalesce(CAST(visit_occurrence_id AS VARCHAR), ''), coalesce(CAST(measurement_source_value AS VARCHAR), ''), '42'))"


@register("staged_measurement_sample", _pull_sql(VITALS_VOCAB).replace("SELECT m.visit", "SELECT * FROM (SELECT m.visit")
          + f") ORDER BY {_SAMPLE_HASH}, visit_occurrence_id, measurement_source_value LIMIT 100", digits=6)
def q_staged_measurement_sample(spark, sf):
    """The comparison frame, persisted and read back."""
    return _staged(spark, sf)[1]


@register("staged_measurement_pull", _pull_sql(VITALS_VOCAB), digits=6)
def q_staged_measurement_pull(spark, sf):
    """The pull persisted as vitals_data, read back."""
    return _staged(spark, sf)[0]


def _staged(spark, sf):
    import uuid

    from ..session import scratch_path
    from ..sources.files import read_parquet_table
    from .cohort import run_stage

    r = Roles(spark, sf)
    main = M.measurement_pull(r.measurement, r.concept, codes=None,
                              concept_filter=F.col("vocabulary_id") == VITALS_VOCAB)
    comp = comparison_sample(main, 100, VISIT_KEYS)
    out = scratch_path(spark, f"stage-{uuid.uuid4().hex}")
    return tuple(read_parquet_table(spark, p) for p in run_stage((main, comp), out, "vitals_data", "vitals_comp_data"))


@register("sample_bottom_k", cte("measurement") + f"""
, s AS (SELECT visit_occurrence_id, measurement_source_value,
  max(value_as_number) AS Max_value, min(value_as_number) AS Min_value,
  round(avg(value_as_number), 6) AS Mean_value
  FROM measurement GROUP BY 1, 2)
SELECT * FROM s ORDER BY {_SAMPLE_HASH}, visit_occurrence_id, measurement_source_value LIMIT 100""", digits=6)
def q_sample_bottom_k(spark, sf):
    r = Roles(spark, sf)
    summary = M.measurement_summary(r.measurement, first_last=False)
    return comparison_sample(summary, 100, VISIT_KEYS)


# ---------------------------------------------------------------- joins

@register("join_full_outer", cte("person", "visit_occurrence") + """
SELECT person_id, v.visit_occurrence_id, v.visit_start_datetime, p.birth_datetime, p.gender_source_value
FROM (SELECT person_id, visit_occurrence_id, visit_start_datetime FROM visit_occurrence) v
FULL JOIN (SELECT person_id, birth_datetime, gender_source_value FROM person) p USING (person_id)""")
def q_join_full_outer(spark, sf):
    r = Roles(spark, sf)
    v = r.visit_occurrence.select("person_id", "visit_occurrence_id", "visit_start_datetime")
    p = r.person.select("person_id", "birth_datetime", "gender_source_value")
    return J.join_tables(v, p, "person_id", "full")


_INTERVAL_SQL = """
SELECT v.person_id, v.visit_occurrence_id, v.visit_start_datetime, v.visit_end_datetime,
       p.payer_plan_period_start_date, p.payer_plan_period_end_date, p.payer_source_value, p.plan_source_value
FROM visit_occurrence v JOIN payer_plan_period p
  ON v.person_id = p.person_id AND v.visit_start_datetime >= p.payer_plan_period_start_date
 AND CAST(v.visit_end_datetime AS DATE) <= p.payer_plan_period_end_date"""


@register("join_payer_interval", cte("visit_occurrence", "payer_plan_period") + _INTERVAL_SQL)
def q_join_payer_interval(spark, sf):
    r = Roles(spark, sf)
    v = r.visit_occurrence.select("person_id", "visit_occurrence_id", "visit_start_datetime", "visit_end_datetime")
    return J.interval_join(v, r.payer_plan_period)


@register("join_latest_payer", cte("payer_plan_period") + """
SELECT p.* FROM payer_plan_period p
JOIN (SELECT person_id, max(payer_plan_period_start_date) AS d FROM payer_plan_period GROUP BY 1) m
  ON p.person_id = m.person_id AND p.payer_plan_period_start_date = m.d""")
def q_join_latest_payer(spark, sf):
    r = Roles(spark, sf)
    return J.latest_per_key(r.payer_plan_period, "person_id", "payer_plan_period_start_date")


@register("join_dimension_chain", cte("person", "care_site", "location") + """
SELECT location_id, care_site_id, x.person_id, x.gender_source_value, x.care_site_name,
       x.place_of_service_source_value, l.state
FROM (SELECT care_site_id, p.person_id, p.gender_source_value, p.location_id, c.care_site_name,
             c.place_of_service_source_value
      FROM (SELECT person_id, gender_source_value, care_site_id, location_id FROM person) p
      FULL JOIN (SELECT care_site_id, care_site_name, place_of_service_source_value FROM care_site) c USING (care_site_id)) x
FULL JOIN location l USING (location_id)""")
def q_join_dimension_chain(spark, sf):
    r = Roles(spark, sf)
    p = r.person.select("person_id", "gender_source_value", "care_site_id", "location_id")
    site = r.care_site.drop("location_id")
    return J.join_tables(J.join_tables(p, site, "care_site_id", "full"), r.location, "location_id", "full")


@register("join_concept_decode", cte("measurement", "concept") + """
SELECT m.visit_occurrence_id, m.measurement_concept_id, m.value_as_number, c.concept_name, c.vocabulary_id
FROM measurement m JOIN concept c ON m.measurement_concept_id = c.concept_id""")
def q_join_concept_decode(spark, sf):
    r = Roles(spark, sf)
    m = r.measurement.select("visit_occurrence_id", "measurement_concept_id", "value_as_number")
    return J.decode(m, r.concept, "measurement_concept_id", concept_cols=["concept_name", "vocabulary_id"])


@register("join_prior_visits", cte("visit_occurrence") + """
, idx AS (SELECT visit_occurrence_id FROM visit_occurrence WHERE discharge_to_source_value = 'F')
SELECT DISTINCT b.person_id, b.visit_occurrence_id
FROM visit_occurrence a JOIN idx ON a.visit_occurrence_id = idx.visit_occurrence_id
JOIN visit_occurrence b ON a.person_id = b.person_id AND b.visit_end_datetime <= a.visit_end_datetime""")
def q_join_prior_visits(spark, sf):
    r = Roles(spark, sf)
    v = r.visit_occurrence
    index = v.where(F.col("discharge_to_source_value") == "F").select("visit_occurrence_id")
    return J.prior_visits(v, index)


@register("join_active_conditions", cte("condition_occurrence", "visit_occurrence") + """
SELECT c.*, v.visit_start_datetime
FROM condition_occurrence c JOIN visit_occurrence v ON c.visit_occurrence_id = v.visit_occurrence_id
WHERE c.condition_start_datetime < v.visit_start_datetime AND c.condition_end_datetime > v.visit_start_datetime""")
def q_join_active_conditions(spark, sf):
    r = Roles(spark, sf)
    return J.active_at_visit(r.condition_occurrence, r.visit_occurrence)


@register("join_active_conditions_person", cte("condition_occurrence", "visit_occurrence") + """
SELECT c.* EXCLUDE (visit_occurrence_id), c.visit_occurrence_id AS recorded_visit_id, v.visit_occurrence_id, v.visit_start_datetime
FROM condition_occurrence c JOIN visit_occurrence v ON c.person_id = v.person_id
WHERE c.condition_start_datetime < v.visit_start_datetime
  AND (c.condition_end_datetime > v.visit_start_datetime OR c.condition_end_datetime IS NULL)""")
def q_join_active_conditions_person(spark, sf):
    """J9 against every visit of the person; conditions without an end are still active."""
    r = Roles(spark, sf)
    return J.active_at_visit(r.condition_occurrence, r.visit_occurrence, scope="person", open_ended=True)


@register("join_birth_year", cte("visit_occurrence", "person") + """
SELECT v.visit_occurrence_id, v.visit_end_datetime, CAST(year(p.birth_datetime) AS INTEGER) AS BirthYear
FROM visit_occurrence v JOIN person p ON v.person_id = p.person_id""")
def q_join_birth_year(spark, sf):
    from ..functions.dates import birth_year
    r = Roles(spark, sf)
    v = r.visit_occurrence.select("visit_occurrence_id", "person_id", "visit_end_datetime")
    return (v.join(r.person.select("person_id", "birth_datetime"), "person_id")
             .select("visit_occurrence_id", "visit_end_datetime", birth_year("birth_datetime").alias("BirthYear")))


@register("join_all_by_column", cte("person", "visit_occurrence", "payer_plan_period") + """
SELECT person_id, p.birth_datetime, p.gender_source_value, v.visit_occurrence_id,
       pp.payer_source_value
FROM (SELECT person_id, birth_datetime, gender_source_value FROM person) p
FULL JOIN (SELECT person_id, visit_occurrence_id FROM visit_occurrence) v USING (person_id)
FULL JOIN (SELECT person_id, payer_source_value FROM payer_plan_period) pp USING (person_id)""")
def q_join_all_by_column(spark, sf):
    r = Roles(spark, sf)
    frames = {
        "person": r.person.select("person_id", "birth_datetime", "gender_source_value"),
        "visit_occurrence": r.visit_occurrence.select("person_id", "visit_occurrence_id"),
        "payer_plan_period": r.payer_plan_period.select("person_id", "payer_source_value"),
        "care_site": r.care_site,
    }
    return J.join_all(frames, "person_id", "full")


@register("join_frames_left", cte("visit_occurrence", "measurement", "condition_occurrence") + """
SELECT v.visit_occurrence_id, v.person_id, m.n_measurements, c.n_conditions
FROM visit_occurrence v
LEFT JOIN (SELECT visit_occurrence_id, count(*) AS n_measurements FROM measurement GROUP BY 1) m USING (visit_occurrence_id)
LEFT JOIN (SELECT visit_occurrence_id, count(*) AS n_conditions FROM condition_occurrence GROUP BY 1) c USING (visit_occurrence_id)""")
def q_join_frames_left(spark, sf):
    r = Roles(spark, sf)
    m = r.measurement.groupBy("visit_occurrence_id").agg(F.count(F.lit(1)).alias("n_measurements"))
    c = r.condition_occurrence.groupBy("visit_occurrence_id").agg(F.count(F.lit(1)).alias("n_conditions"))
    return J.join_frames([r.visit_occurrence.select("visit_occurrence_id", "person_id"), m, c], "visit_occurrence_id")


# ---------------------------------------------------------------- cohort

_DEMO_VISIT_SQL = """
, v AS (SELECT person_id, visit_occurrence_id, visit_start_datetime, visit_end_datetime,
               datediff('second', visit_start_datetime, visit_end_datetime) AS visit_length FROM visit_occurrence)
, ins AS (SELECT DISTINCT v.visit_occurrence_id, p.payer_source_value, p.plan_source_value
          FROM v JOIN payer_plan_period p ON v.person_id = p.person_id
           AND v.visit_start_datetime >= p.payer_plan_period_start_date
           AND CAST(v.visit_end_datetime AS DATE) <= p.payer_plan_period_end_date)
, pv AS (SELECT * , CAST(floor(datediff('day', birth_datetime, visit_start_datetime) / 365.25) AS BIGINT) AS age
         FROM v FULL JOIN (SELECT person_id, birth_datetime, death_datetime, gender_source_value, race_source_value,
                                  ethnicity_source_value, care_site_id, location_id FROM person) pe USING (person_id))
, m1 AS (SELECT * FROM pv FULL JOIN ins USING (visit_occurrence_id))
, m2 AS (SELECT * FROM m1 FULL JOIN (SELECT care_site_id, care_site_name, place_of_service_source_value FROM care_site) USING (care_site_id))
, demo AS (SELECT visit_occurrence_id, person_id, birth_datetime, death_datetime, gender_source_value, race_source_value,
                  ethnicity_source_value, age, visit_start_datetime, visit_end_datetime, visit_length,
                  payer_source_value, plan_source_value, care_site_id, location_id, care_site_name,
                  place_of_service_source_value, state
           FROM m2 FULL JOIN location USING (location_id))
"""

_DEMO_COLS = """visit_occurrence_id, person_id, birth_datetime, death_datetime, gender_source_value, race_source_value,
  ethnicity_source_value, age, visit_start_datetime, visit_end_datetime, visit_length, payer_source_value,
  plan_source_value, care_site_id, location_id, care_site_name, place_of_service_source_value, state"""


@register("demographics_visit", cte("person", "visit_occurrence", "payer_plan_period", "care_site", "location")
          + _DEMO_VISIT_SQL + f"SELECT {_DEMO_COLS} FROM demo")
def q_demographics_visit(spark, sf):
    main, _ = demographic_pull(_tables(Roles(spark, sf)), "visit_occurrence_id")
    return main


def _bottom_k(hashed: str, columns: str, n: int = 100) -> str:
    """ORDER BY and LIMIT of a comparison sample (X2): seeded hash of the key, then every column."""
    order = ", ".join(f"{c.strip()} NULLS FIRST" for c in columns.split(","))
    return f"ORDER BY md5(concat_ws('|', coalesce(CAST({hashed} AS VARCHAR), ''), '42')), {order} LIMIT {n}"


@register("demographics_visit_sample", cte("person", "visit_occurrence", "payer_plan_period", "care_site", "location")
          + _DEMO_VISIT_SQL + f"SELECT {_DEMO_COLS} FROM demo {_bottom_k('visit_occurrence_id', _DEMO_COLS)}")
def q_demographics_visit_sample(spark, sf):
    """The comparison frame of C1: of the unfiltered cohort."""
    return demographic_pull(_tables(Roles(spark, sf)), "visit_occurrence_id", CohortFilter(age=COHORT_AGE),
                            rand_sample_size=100)[1]


@register("cohort_filters", cte("person", "visit_occurrence", "payer_plan_period", "care_site", "location")
          + _DEMO_VISIT_SQL + f"""SELECT {_DEMO_COLS} FROM demo
WHERE age BETWEEN 30 AND 50 AND gender_source_value IN ('Female')
  AND race_source_value IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE')
  AND visit_start_datetime BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '2000-12-31 00:00:00'
  AND state IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')""")
def q_cohort_filters(spark, sf):
    import datetime as dt
    flt = CohortFilter(age=[30, 50], gender="Female", race=["BUILDING", "MACHINERY", "AUTOMOBILE"],
                       visit_date=[dt.datetime(1996, 1, 1), dt.datetime(2000, 12, 31)],
                       visit_location={"state": ["AFRICA", "AMERICA", "ASIA", "EUROPE"]})
    main, _ = demographic_pull(_tables(Roles(spark, sf)), "visit_occurrence_id", flt)
    return main


@register("demographics_person", cte("person", "visit_occurrence", "payer_plan_period", "care_site", "location") + """
, v AS (SELECT person_id, visit_occurrence_id, visit_start_datetime, visit_end_datetime,
               datediff('second', visit_start_datetime, visit_end_datetime) AS visit_length FROM visit_occurrence)
, ins AS (SELECT p.person_id, p.payer_source_value, p.plan_source_value FROM payer_plan_period p
          JOIN (SELECT person_id, max(payer_plan_period_start_date) AS d FROM payer_plan_period GROUP BY 1) m
            ON p.person_id = m.person_id AND p.payer_plan_period_start_date = m.d)
, pv AS (SELECT *, CASE WHEN death_datetime IS NULL
                        THEN CAST(floor(datediff('day', birth_datetime, DATE '2024-01-01') / 365.25) AS BIGINT)
                        ELSE CAST(floor(datediff('day', birth_datetime, death_datetime) / 365.25) AS BIGINT) END AS age
         FROM v FULL JOIN (SELECT person_id, birth_datetime, death_datetime, gender_source_value, race_source_value,
                                  ethnicity_source_value, care_site_id, location_id FROM person) pe USING (person_id))
, m1 AS (SELECT * FROM pv FULL JOIN ins USING (person_id))
, m2 AS (SELECT * FROM m1 FULL JOIN (SELECT care_site_id, care_site_name, place_of_service_source_value FROM care_site) USING (care_site_id))
SELECT visit_occurrence_id, person_id, birth_datetime, death_datetime, gender_source_value, race_source_value,
  ethnicity_source_value, age, visit_start_datetime, visit_end_datetime, visit_length, payer_source_value,
  plan_source_value, care_site_id, location_id, care_site_name, place_of_service_source_value, state
FROM m2 FULL JOIN location USING (location_id)""")
def q_demographics_person(spark, sf):
    main, _ = demographic_pull(_tables(Roles(spark, sf)), "person_id", as_of="2024-01-01")
    return main


@register("cohort_combined", cte("person", "visit_occurrence", "payer_plan_period", "care_site", "location",
                                 "measurement", "concept") + _DEMO_VISIT_SQL + f"""
, vit AS (SELECT m.visit_occurrence_id, m.measurement_source_value, {_MEASURE_AGGS}
          FROM measurement m JOIN concept c ON m.measurement_concept_id = c.concept_id
          WHERE c.vocabulary_id = '{VITALS_VOCAB}' GROUP BY 1, 2)
SELECT * FROM (SELECT {_DEMO_COLS} FROM demo WHERE age BETWEEN {COHORT_AGE[0]} AND {COHORT_AGE[1]}) d
LEFT JOIN vit USING (visit_occurrence_id)""", digits=6)
def q_cohort_combined(spark, sf):
    r = Roles(spark, sf)
    main, _ = cohort_combined(_tables(r), r.measurement, r.concept, codes=None,
                              concept_filter=F.col("vocabulary_id") == VITALS_VOCAB,
                              filters=CohortFilter(age=COHORT_AGE))
    return main


_VITALS_SQL = f"""
, vit AS (SELECT m.visit_occurrence_id, m.measurement_source_value, {_MEASURE_AGGS}
          FROM measurement m JOIN concept c ON m.measurement_concept_id = c.concept_id
          WHERE c.vocabulary_id = '{VITALS_VOCAB}' GROUP BY 1, 2)
"""


@register("cohort_combined_sample", cte("person", "visit_occurrence", "payer_plan_period", "care_site", "location",
                                        "measurement", "concept") + _DEMO_VISIT_SQL + _VITALS_SQL + f"""
, ds AS (SELECT {_DEMO_COLS} FROM demo {_bottom_k('visit_occurrence_id', _DEMO_COLS, 1000)})
, vs AS (SELECT * FROM vit ORDER BY md5(concat_ws('|', coalesce(CAST(visit_occurrence_id AS VARCHAR), ''),
           coalesce(measurement_source_value, ''), '42')), visit_occurrence_id NULLS FIRST, measurement_source_value NULLS FIRST LIMIT 1000)
SELECT * FROM ds LEFT JOIN vs USING (visit_occurrence_id)""", digits=6)
def q_cohort_combined_sample(spark, sf):
    """The comparison frame of C4: samples of the unfiltered cohort and of its measurements, joined."""
    r = Roles(spark, sf)
    return cohort_combined(_tables(r), r.measurement, r.concept, codes=None, concept_filter=F.col("vocabulary_id") == VITALS_VOCAB,
                           filters=CohortFilter(age=COHORT_AGE), rand_sample_size=1000)[1]


_DEMO_PERSON_SQL = ORACLES["demographics_person"]


@register("demographics_person_sample", f"SELECT * FROM ({_DEMO_PERSON_SQL}) {_bottom_k('person_id', _DEMO_COLS)}")
def q_demographics_person_sample(spark, sf):
    """The comparison frame of C2."""
    return demographic_pull(_tables(Roles(spark, sf)), "person_id", CohortFilter(age=COHORT_AGE), rand_sample_size=100,
                            as_of="2024-01-01")[1]


@register("demographics_person_one_row", cte("person", "visit_occurrence", "payer_plan_period", "care_site", "location") + """
, v AS (SELECT person_id, count(*) AS n_visits, min(visit_start_datetime) AS first_visit_start, max(visit_start_datetime) AS last_visit_start,
               CAST(sum(datediff('second', visit_start_datetime, visit_end_datetime)) AS BIGINT) AS total_visit_length
        FROM visit_occurrence GROUP BY 1)
, ins AS (SELECT person_id, min(ROW(payer_source_value, plan_source_value)) AS p FROM payer_plan_period
          JOIN (SELECT person_id, max(payer_plan_period_start_date) AS d FROM payer_plan_period GROUP BY 1) USING (person_id)
          WHERE payer_plan_period_start_date = d GROUP BY 1)
SELECT person_id, birth_datetime, death_datetime, gender_source_value, race_source_value, ethnicity_source_value,
       CAST(floor(datediff('day', birth_datetime, coalesce(death_datetime, DATE '2024-01-01')) / 365.25) AS BIGINT) AS age,
       coalesce(n_visits, 0) AS n_visits, first_visit_start, last_visit_start, total_visit_length,
       p[1] AS payer_source_value, p[2] AS plan_source_value, care_site_id, pe.location_id, care_site_name,
       place_of_service_source_value, state
FROM (SELECT * FROM person) pe FULL JOIN v USING (person_id) FULL JOIN ins USING (person_id)
LEFT JOIN (SELECT care_site_id, care_site_name, place_of_service_source_value FROM care_site) USING (care_site_id)
LEFT JOIN location l ON pe.location_id = l.location_id""")
def q_demographics_person_one_row(spark, sf):
    """C2 with one row per person and without sites and locations that nobody names."""
    return demographic_pull(_tables(Roles(spark, sf)), "person_id", as_of="2024-01-01", how="left", one_row_per_person=True)[0]


def _site_sql(how: str) -> str:
    return (cte("person", "visit_with_site", "payer_plan_period", "care_site", "location")
            + _DEMO_VISIT_SQL[:_DEMO_VISIT_SQL.index(", pv AS")].replace("FROM visit_occurrence", "FROM visit_with_site")
            .replace("AS visit_length", "AS visit_length, care_site_id") + f"""
, pv AS (SELECT *, CAST(floor(datediff('day', birth_datetime, visit_start_datetime) / 365.25) AS BIGINT) AS age
         FROM v FULL JOIN (SELECT person_id, birth_datetime, death_datetime, gender_source_value, race_source_value,
                                  ethnicity_source_value FROM person) pe USING (person_id))
, m1 AS (SELECT * FROM pv FULL JOIN ins USING (visit_occurrence_id))
, m2 AS (SELECT * FROM m1 {how} JOIN care_site USING (care_site_id))
SELECT {_DEMO_COLS} FROM m2 {how} JOIN location USING (location_id)""")


def _tables_with_site(r: Roles) -> CohortTables:
    return replace(_tables(r), visit_occurrence=r.visit_with_site)


@register("demographics_visit_site", _site_sql("FULL"))
def q_demographics_visit_site(spark, sf):
    """C1 with the visit's care site and that site's location."""
    return demographic_pull(_tables_with_site(Roles(spark, sf)), "visit_occurrence_id", site_from="visit")[0]


@register("demographics_visit_site_left", _site_sql("LEFT"))
def q_demographics_visit_site_left(spark, sf):
    return demographic_pull(_tables_with_site(Roles(spark, sf)), "visit_occurrence_id", site_from="visit", how="left")[0]
