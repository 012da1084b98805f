"""Registered queries: scans and sinks, filters, scalar functions, unions (IO1-IO11, F1-F18, M1-M12, X3)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import features as FE
from ..operators import filters as FL
from ..operators import quality as Q
from ..operators.sampling import union_all
from ..session import scratch_path
from ..sources import catalog as CAT
from ..sources import files as IO
from .reg_features import _ICD_SQL
from .registry import register
from .roles import Roles, cte

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
                 "benchmark labels conversations").split()


def _scratch(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


# ------------------------------------------------------------- scans and sinks

@register("io_load_table", "SELECT * FROM lineitem")
def q_io_load_table(spark, sf):
    return IO.read_parquet_table(spark, f"{sf}/lineitem.parquet")


@register("io_describe_table", "SELECT count(*) AS row_count, CAST(11 AS BIGINT) AS column_count FROM lineitem")
def q_io_describe_table(spark, sf):
    return IO.describe_table(IO.read_parquet_table(spark, f"{sf}/lineitem.parquet"))


@register("io_catalog", f"""
SELECT table_name, CAST(ordinal_position AS INT) AS ordinal, column_name
FROM information_schema.columns
WHERE table_name IN ({', '.join(f"'{t}'" for t in DRIVER_TABLES)})""")
def q_io_catalog(spark, sf):
    tables = {t: IO.read_parquet_table(spark, f"{sf}/{t}.parquet") for t in DRIVER_TABLES}
    # Engine type names differ between Spark and SQL engines; the check
    # compares the catalog's table, position and column name.
    return CAT.read_catalog(spark, tables).select("table_name", "ordinal", "column_name")


@register("io_tables_with_column", f"""
SELECT DISTINCT table_name FROM information_schema.columns
WHERE column_name = 'doc_id' AND table_name IN ({', '.join(f"'{t}'" for t in DRIVER_TABLES)})""")
def q_io_tables_with_column(spark, sf):
    tables = {t: IO.read_parquet_table(spark, f"{sf}/{t}.parquet") for t in DRIVER_TABLES}
    return CAT.tables_with_column(CAT.read_catalog(spark, tables), "doc_id")


_PERSON_SCHEMA = ("person_id BIGINT, birth_datetime DATE, death_datetime DATE, gender_source_value STRING, "
                  "race_source_value STRING, ethnicity_source_value STRING, care_site_id BIGINT, location_id BIGINT")


@register("io_csv_roundtrip", cte("person") + "SELECT * FROM person", digits=6)
def q_io_csv_roundtrip(spark, sf):
    path = _scratch(spark, "person-csv")
    IO.write_csv(Roles(spark, sf).person, path, header=False, null_value="\\N")
    return IO.read_csv(spark, path, _PERSON_SCHEMA, header=False, null_value="\\N")


@register("io_parquet_roundtrip", cte("measurement") + """
SELECT visit_occurrence_id, measurement_source_value, max(value_as_number) AS Max_value,
  min(value_as_number) AS Min_value, round(avg(value_as_number), 6) AS Mean_value
FROM measurement GROUP BY 1, 2""", digits=6)
def q_io_parquet_roundtrip(spark, sf):
    from ..operators.measures import measurement_summary
    path = _scratch(spark, "summary-parquet")
    IO.write_table(measurement_summary(Roles(spark, sf).measurement, first_last=False), path)
    return IO.read_parquet_table(spark, path)


@register("io_csv_arrays_as_text", cte("procedure_occurrence", "concept") + """
, e AS (SELECT visit_occurrence_id, person_id, procedure_concept_id, procedure_source_value, concept_name, concept_code, count(*) AS n
  FROM procedure_occurrence JOIN concept ON procedure_concept_id = concept_id AND vocabulary_id = 'PROMO' GROUP BY ALL)
SELECT visit_occurrence_id, person_id, CAST(sum(n) AS BIGINT) AS n_items,
  '[' || string_agg('{' || concat_ws(', ', CAST(procedure_concept_id AS VARCHAR), procedure_source_value, concept_name,
                                     concept_code, CAST(n AS VARCHAR)) || '}', ', '
                    ORDER BY procedure_concept_id, procedure_source_value, concept_name, concept_code) || ']' AS procedures
FROM e GROUP BY 1, 2""")
def q_io_csv_arrays_as_text(spark, sf):
    from ..operators import rollups as R
    r = Roles(spark, sf)
    path = _scratch(spark, "procedures-csv")
    cols = ["procedure_concept_id", "procedure_source_value", "concept_name", "concept_code"]
    rolled = R.rollup_procedures(r.procedure_occurrence, r.concept, "PROMO", cols=cols)
    IO.write_csv(R.collect_items(rolled, R.KEYS, cols, "procedures"), path)
    return IO.read_csv(spark, path, "visit_occurrence_id BIGINT, person_id BIGINT, n_items BIGINT, procedures STRING",
                       header=True)


@register("io_json_roundtrip", cte("scores") + """
SELECT CAST(least(floor(score * 10), 9) AS INT) AS bin, round(avg(score), 6) AS mean_predicted,
       round(avg(CAST(label AS DOUBLE)), 6) AS fraction_positive, count(*) AS count
FROM scores GROUP BY 1""", digits=6)
def q_io_json_roundtrip(spark, sf):
    from ..operators.evaluation import reliability
    path = _scratch(spark, "report-json")
    IO.write_json(reliability(Roles(spark, sf).scores), path)
    return IO.read_json(spark, path, "bin INT, mean_predicted DOUBLE, fraction_positive DOUBLE, count BIGINT")


def _code_lines(r):
    """A fixed-width code file derived from the diagnosis codes of the data:
    order number (5) + space, code without its dot (8, padded), two spaces, text."""
    codes = r.diagnosis_extract.select("condition_source_value").distinct()
    code = F.regexp_replace("condition_source_value", r"\.", "")
    line = F.concat(F.lpad(F.lit("1"), 5, "0"), F.lit(" "), F.rpad(code, 8, " "), F.lit("  "),
                    F.concat(F.lit("Diagnosis "), F.col("condition_source_value")))
    return codes.select(line.alias("value"))


_CODES_SQL = """
, codes AS (SELECT DISTINCT condition_source_value AS v FROM diagnosis_extract)
, parsed AS (SELECT substr(replace(v, '.', ''), 1, 3) || '.' || substr(replace(v, '.', ''), 4, 8) AS code,
                    'Diagnosis ' || v AS description FROM codes)
"""


@register("io_fixed_width", cte("diagnosis_extract") + _CODES_SQL + "SELECT * FROM parsed")
def q_io_fixed_width(spark, sf):
    path = _scratch(spark, "codes-txt")
    _code_lines(Roles(spark, sf)).write.mode("overwrite").text(path)
    return IO.load_fixed_width_codes(spark, path)


def _class_file(spark, r):
    path = _scratch(spark, "classes-csv")
    m = r.medication_classification
    m.select(F.concat(F.lit("http://example.org/class/"), F.col("ATC_2")).alias("Class ID"),
             F.concat(F.lit("Class "), F.col("ATC_2")).alias("Preferred Label")).distinct() \
     .write.mode("overwrite").option("header", True).csv(path)
    return IO.load_class_codes(IO.read_csv(spark, path, "`Class ID` STRING, `Preferred Label` STRING", header=True))


@register("io_uri_tail", cte("medication_classification") + """
SELECT DISTINCT ATC_2 AS code, 'Class ' || ATC_2 AS label FROM medication_classification""")
def q_io_uri_tail(spark, sf):
    return _class_file(spark, Roles(spark, sf))


@register("feature_labels", cte("diagnosis_extract", "medications", "medication_classification")
          + _ICD_SQL
          + _CODES_SQL + """
, atcf AS (SELECT DISTINCT 'MEDTBL_' || regexp_replace(regexp_replace(ATC_2, '\\.', '_', 'g'), '[ ,;{}()\\n\\t=]+', '', 'g') AS feature, ATC_2 AS code
           FROM medications m JOIN medication_classification k ON m.drug_concept_id = k.drug_concept_id)
, fe AS (SELECT DISTINCT feature FROM icd UNION SELECT feature FROM atcf)
, sp AS (SELECT feature, string_split(feature, '_') AS parts FROM fe)
, k AS (SELECT feature,
          CASE WHEN starts_with(feature, 'DETBL_') THEN
            CASE WHEN len(parts) > 2 THEN parts[2] || '.' || parts[3] ELSE parts[2] || '.' END END AS icd,
          CASE WHEN starts_with(feature, 'MEDTBL_') THEN parts[2] END AS atc FROM sp)
SELECT k.feature,
  CASE WHEN p.description IS NOT NULL THEN 'DETBL_' || p.description
       WHEN c.code IS NOT NULL THEN 'MEDTBL_' || 'Class ' || c.code ELSE k.feature END AS readable
FROM k LEFT JOIN parsed p ON k.icd = p.code
LEFT JOIN (SELECT DISTINCT ATC_2 AS code FROM medication_classification) c ON k.atc = c.code""")
def q_feature_labels(spark, sf):
    r = Roles(spark, sf)
    path = _scratch(spark, "codes-txt")
    _code_lines(r).write.mode("overwrite").text(path)
    codes = IO.load_fixed_width_codes(spark, path)
    classes = _class_file(spark, r)
    meds = r.medications.join(r.medication_classification, "drug_concept_id")
    feats = FE.code_level_counts(r.diagnosis_extract).unionByName(FE.class_level_counts(meds, ["ATC_2"]))
    return FE.feature_labels(feats, codes, classes)


# ------------------------------------------------------------- filters

_MEAS = "SELECT visit_occurrence_id, measurement_concept_id, value_as_number, l_linenumber FROM measurement"


def _meas(r):
    return r.measurement.select("visit_occurrence_id", "measurement_concept_id", "value_as_number", "l_linenumber")


@register("filter_numeric_range", cte("measurement") + _MEAS + " WHERE value_as_number BETWEEN 10000 AND 40000")
def q_filter_numeric_range(spark, sf):
    return FL.filter_numeric(_meas(Roles(spark, sf)), "value_as_number", [10000, 40000])


@register("filter_numeric_point", cte("measurement") + _MEAS + " WHERE l_linenumber = 3")
def q_filter_numeric_point(spark, sf):
    return FL.filter_numeric(_meas(Roles(spark, sf)), "l_linenumber", [3])


@register("filter_in", cte("person") + "SELECT * FROM person WHERE race_source_value IN ('BUILDING', 'MACHINERY')")
def q_filter_in(spark, sf):
    return FL.filter_in(Roles(spark, sf).person, "race_source_value", ["BUILDING", "MACHINERY"])


@register("filter_not_in", cte("person") + """
SELECT * FROM person WHERE ethnicity_source_value NOT IN ('Non-Hispanic') OR ethnicity_source_value IS NULL""")
def q_filter_not_in(spark, sf):
    return FL.filter_not_in(Roles(spark, sf).person, "ethnicity_source_value", ["Non-Hispanic"], keep_null=True)


@register("filter_datetime_range", cte("visit_occurrence") + """
SELECT * FROM visit_occurrence
WHERE visit_start_datetime BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1997-12-31 00:00:00'""")
def q_filter_datetime_range(spark, sf):
    return FL.filter_datetime(Roles(spark, sf).visit_occurrence, "visit_start_datetime",
                              [dt.datetime(1996, 1, 1), dt.datetime(1997, 12, 31)])


@register("filter_by_map", cte("person") + """
SELECT * FROM person WHERE race_source_value IN ('BUILDING', 'HOUSEHOLD') AND gender_source_value IN ('Male')""")
def q_filter_by_map(spark, sf):
    return FL.filter_by_map(Roles(spark, sf).person, {"race_source_value": ["BUILDING", "HOUSEHOLD"],
                                                      "gender_source_value": "Male"})


@register("filter_contains_any", cte("concept") + """
SELECT * FROM concept WHERE contains(concept_name, 'red') OR contains(concept_name, 'ring')""")
def q_filter_contains_any(spark, sf):
    return FL.filter_contains(Roles(spark, sf).concept, "concept_name", ["red", "ring"])


@register("filter_flag", cte("lab_flag") + "SELECT * FROM lab_flag WHERE lower(is_positive) = 'true'")
def q_filter_flag(spark, sf):
    return FL.filter_flag(Roles(spark, sf).lab_flag, "is_positive", True)


@register("restrict_semi", cte("measurement", "visit_occurrence") + _MEAS + """
WHERE visit_occurrence_id IN (SELECT visit_occurrence_id FROM visit_occurrence WHERE discharge_to_source_value = 'F')""")
def q_restrict_semi(spark, sf):
    r = Roles(spark, sf)
    ids = r.visit_occurrence.where(F.col("discharge_to_source_value") == "F")
    return FL.restrict_to(_meas(r), ids, "visit_occurrence_id")


@register("filter_since_start", cte("measurement", "visit_occurrence") + """
SELECT m.visit_occurrence_id, m.measurement_source_value, m.measurement_datetime, m.value_as_number, v.visit_start_datetime
FROM measurement m JOIN visit_occurrence v ON m.visit_occurrence_id = v.visit_occurrence_id
WHERE datediff('second', v.visit_start_datetime, m.measurement_datetime) BETWEEN 0 AND 2592000""")
def q_filter_since_start(spark, sf):
    r = Roles(spark, sf)
    m = r.measurement.select("visit_occurrence_id", "measurement_source_value", "measurement_datetime",
                             "value_as_number")
    j = m.join(r.visit_occurrence.select("visit_occurrence_id", "visit_start_datetime"), "visit_occurrence_id")
    return FL.filter_since_start(j, "measurement_datetime", "visit_start_datetime", 30 * 24 * 3600)


@register("clean_columns", cte("diagnosis_extract") + """
SELECT visit_occurrence_id AS "X_visit_occurrence_id", chief_complaint AS "X_chief_complaint",
       condition_source_value AS "X_codevalue" FROM diagnosis_extract""")
def q_clean_columns(spark, sf):
    d = Roles(spark, sf).diagnosis_extract.select(
        F.col("visit_occurrence_id").alias("visit.occurrence.id"), F.col("chief_complaint").alias("chief.complaint"),
        F.col("condition_source_value").alias("code (value)"))
    return FL.clean_columns(d, prefix="X_")


@register("fill_zero", cte("visit_occurrence", "lab_flag") + """
SELECT v.visit_occurrence_id, v.visit_end_datetime, coalesce(c.n_labs, 0) AS n_labs
FROM visit_occurrence v LEFT JOIN (SELECT visit_occurrence_id, count(*) AS n_labs FROM lab_flag GROUP BY 1) c
  ON v.visit_occurrence_id = c.visit_occurrence_id""")
def q_fill_zero(spark, sf):
    r = Roles(spark, sf)
    c = r.lab_flag.groupBy("visit_occurrence_id").agg(F.count(F.lit(1)).alias("n_labs"))
    j = r.visit_occurrence.select("visit_occurrence_id", "visit_end_datetime").join(c, "visit_occurrence_id", "left")
    return FL.fill_zero(j, ["n_labs"])


@register("distinct_rows", cte("measurement") + """
SELECT DISTINCT visit_occurrence_id, measurement_source_value FROM measurement""")
def q_distinct_rows(spark, sf):
    return FL.distinct_rows(Roles(spark, sf).measurement.select("visit_occurrence_id", "measurement_source_value"))


@register("union_all", cte("procedure_occurrence", "drug_exposure") + """
SELECT visit_occurrence_id, procedure_concept_id AS concept_id, 'procedure' AS kind FROM procedure_occurrence
UNION ALL SELECT visit_occurrence_id, drug_concept_id, 'drug' FROM drug_exposure""")
def q_union_all(spark, sf):
    r = Roles(spark, sf)
    p = r.procedure_occurrence.select("visit_occurrence_id", F.col("procedure_concept_id").alias("concept_id"),
                                      F.lit("procedure").alias("kind"))
    d = r.drug_exposure.select("visit_occurrence_id", F.col("drug_concept_id").alias("concept_id"),
                               F.lit("drug").alias("kind"))
    return union_all([p, d])


# ------------------------------------------------------------- scalar functions

@register("fn_visit_length", cte("visit_occurrence") + """
SELECT visit_occurrence_id, datediff('second', visit_start_datetime, visit_end_datetime) AS visit_length
FROM visit_occurrence""")
def q_fn_visit_length(spark, sf):
    v = Roles(spark, sf).visit_occurrence
    return v.select("visit_occurrence_id", D.visit_length("visit_start_datetime", "visit_end_datetime")
                    .alias("visit_length"))


_VP = "FROM visit_occurrence v JOIN person p ON v.person_id = p.person_id"


def _vp(r):
    return r.visit_occurrence.join(r.person, "person_id")


@register("fn_age_at_visit", cte("visit_occurrence", "person") + f"""
SELECT v.visit_occurrence_id, CAST(floor(datediff('day', p.birth_datetime, v.visit_start_datetime) / 365.25) AS BIGINT) AS age {_VP}""")
def q_fn_age_at_visit(spark, sf):
    return _vp(Roles(spark, sf)).select("visit_occurrence_id",
                                        D.age_at("visit_start_datetime", "birth_datetime").alias("age"))


@register("fn_age_current", cte("person") + """
SELECT person_id, CASE WHEN death_datetime IS NULL THEN CAST(floor(datediff('day', birth_datetime, DATE '2024-01-01') / 365.25) AS BIGINT)
  ELSE CAST(floor(datediff('day', birth_datetime, death_datetime) / 365.25) AS BIGINT) END AS age FROM person""")
def q_fn_age_current(spark, sf):
    p = Roles(spark, sf).person
    return p.select("person_id", D.age_current("birth_datetime", "death_datetime", "2024-01-01").alias("age"))


@register("fn_age_fractional", cte("visit_occurrence", "person") + f"""
SELECT v.visit_occurrence_id, round(datediff('day', p.birth_datetime, v.visit_start_datetime) / 365.25, 6) AS age {_VP}""")
def q_fn_age_fractional(spark, sf):
    return _vp(Roles(spark, sf)).select(
        "visit_occurrence_id", F.round(D.age_fractional("visit_start_datetime", "birth_datetime"), 6).alias("age"))


@register("fn_age_by_year", cte("visit_occurrence", "person") + f"""
SELECT v.visit_occurrence_id, CAST(year(v.visit_end_datetime) - year(p.birth_datetime) AS INTEGER) AS age {_VP}""")
def q_fn_age_by_year(spark, sf):
    return _vp(Roles(spark, sf)).select("visit_occurrence_id",
                                        D.age_by_year("visit_end_datetime", "birth_datetime").alias("age"))


@register("fn_to_date", cte("visit_occurrence") + """
, t AS (SELECT visit_occurrence_id, CASE WHEN discharge_to_source_value = 'P' THEN 'pending'
          ELSE strftime(visit_start_datetime, '%Y-%m-%d') END AS txt FROM visit_occurrence)
SELECT visit_occurrence_id, txt, TRY_CAST(txt AS DATE) AS d FROM t""")
def q_fn_to_date(spark, sf):
    v = Roles(spark, sf).visit_occurrence
    t = v.select("visit_occurrence_id", F.when(F.col("discharge_to_source_value") == "P", F.lit("pending"))
                 .otherwise(F.date_format("visit_start_datetime", "yyyy-MM-dd")).alias("txt"))
    return t.withColumn("d", D.to_date_safe("txt", "yyyy-MM-dd"))


@register("fn_percent_text", cte("person") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"Column\", CAST(round(CAST(count_if({c} IS NULL OR CAST({c} AS VARCHAR) = '') AS DOUBLE) * 100.0 "
    f"/ count(*), 6) AS VARCHAR) || '%' AS NullPercentage FROM person"
    for c in ("ethnicity_source_value", "death_datetime", "gender_source_value")))
def q_fn_percent_text(spark, sf):
    n = Q.null_percentage(Roles(spark, sf).person, ["ethnicity_source_value", "death_datetime", "gender_source_value"])
    return n.select("Column", Q.percent_text(F.round("NullPercentage", 6)).alias("NullPercentage"))
