"""Registered queries: roll-ups, dossier, phenotype features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import rollups as R
from ..sources.files import load_targets
from .dossier import patient_dossier
from .phenotype import CC_VALUES, families, phenotype_table
from .registry import register
from .roles import Roles, cte

_STRIP = "'[ ,;{}()\\n\\t=]+'"


def _clean_sql(expr: str, prefix: str, dots: bool) -> str:
    e = f"coalesce(CAST({expr} AS VARCHAR), 'null')"
    if dots:
        e = f"regexp_replace({e}, '\\.', '_', 'g')"
    return f"'{prefix}' || regexp_replace({e}, {_STRIP}, '', 'g')"


# ------------------------------------------------------------- roll-ups

_COND_SRC = """SELECT c.*, k.concept_name, k.vocabulary_id, k.domain_id, k.concept_class_id, k.concept_code
  FROM condition_occurrence c JOIN visit_occurrence v ON c.visit_occurrence_id = v.visit_occurrence_id
  JOIN concept k ON c.condition_concept_id = k.concept_id
  WHERE c.condition_start_datetime < v.visit_start_datetime AND c.condition_end_datetime > v.visit_start_datetime"""
_PROC_SRC = """SELECT p.*, k.concept_name, k.vocabulary_id, k.concept_code FROM procedure_occurrence p
  JOIN concept k ON p.procedure_concept_id = k.concept_id AND k.vocabulary_id = 'PROMO'"""
_DRUG_SRC = """SELECT d.*, k.concept_name, k.vocabulary_id FROM drug_exposure d
  JOIN concept k ON d.drug_concept_id = k.concept_id"""


def _rollup_sql(src: str, fields, keys: str = "visit_occurrence_id, person_id") -> str:
    return f"SELECT {keys}, {', '.join(fields)}, count(*) AS n FROM ({src}) s GROUP BY ALL"


@register("rollup_conditions", cte("condition_occurrence", "visit_occurrence", "concept")
          + _rollup_sql(_COND_SRC, R.CONDITION_COLS))
def q_rollup_conditions(spark, sf):
    r = Roles(spark, sf)
    return R.rollup_conditions(r.condition_occurrence, r.visit_occurrence, r.concept)


@register("rollup_procedures", cte("procedure_occurrence", "concept") + _rollup_sql(_PROC_SRC, R.PROCEDURE_COLS))
def q_rollup_procedures(spark, sf):
    r = Roles(spark, sf)
    return R.rollup_procedures(r.procedure_occurrence, r.concept, "PROMO")


@register("rollup_drugs", cte("drug_exposure", "concept") + _rollup_sql(_DRUG_SRC, R.DRUG_COLS))
def q_rollup_drugs(spark, sf):
    r = Roles(spark, sf)
    return R.rollup_drugs(r.drug_exposure, r.concept)


_BYTYPE_FIELDS = ["condition_concept_id", "condition_source_value", "condition_start_datetime"]


@register("rollup_by_type", cte("condition_occurrence") + _rollup_sql(
    "SELECT * FROM condition_occurrence", _BYTYPE_FIELDS, "visit_occurrence_id, person_id, condition_type_source_value"))
def q_rollup_by_type(spark, sf):
    r = Roles(spark, sf)
    return R.rollup_by(r.condition_occurrence, R.KEYS, "condition_type_source_value", _BYTYPE_FIELDS)


@register("rollup_observations", cte("observation", "concept") + """
SELECT visit_occurrence_id, concept_name, observation_source_value, count(*) AS n
FROM observation JOIN concept ON observation_concept_id = concept_id GROUP BY ALL""")
def q_rollup_observations(spark, sf):
    r = Roles(spark, sf)
    return R.rollup_observations(r.observation, r.concept)


@register("observation_search", cte("observation", "concept") + """
SELECT visit_occurrence_id, concept_name, observation_source_value, count(*) AS n
FROM observation JOIN concept ON observation_concept_id = concept_id
WHERE contains(concept_name, 'green') OR contains(concept_name, 'blue') GROUP BY ALL""")
def q_observation_search(spark, sf):
    r = Roles(spark, sf)
    return R.rollup_observations(r.observation, r.concept, search=["green", "blue"])


@register("observation_counts", cte("observation") + """
SELECT visit_occurrence_id, observation_source_value, count(*) AS n_events
FROM observation GROUP BY 1, 2""")
def q_observation_counts(spark, sf):
    return R.count_by_type(Roles(spark, sf).observation, ["visit_occurrence_id"], "observation_source_value")


@register("outcomes", cte("visit_occurrence", "person") + """
SELECT v.visit_occurrence_id, v.person_id, v.discharge_to_source_value AS disposition,
  CASE WHEN p.death_datetime IS NULL THEN 0 WHEN p.death_datetime >= CAST(v.visit_start_datetime AS DATE) THEN 1 ELSE 0 END AS died,
  datediff('second', v.visit_start_datetime, v.visit_end_datetime) AS length_of_stay
FROM visit_occurrence v LEFT JOIN person p ON v.person_id = p.person_id""")
def q_outcomes(spark, sf):
    r = Roles(spark, sf)
    return R.outcomes(r.visit_occurrence, r.person)


@register("filter_age_floor", cte("person", "visit_occurrence") + """
SELECT DISTINCT p.person_id, p.birth_datetime, p.death_datetime, p.gender_source_value, p.race_source_value,
  p.ethnicity_source_value, datediff('day', p.birth_datetime, v.visit_start_datetime) / 365.25 AS age
FROM person p JOIN visit_occurrence v ON p.person_id = v.person_id
WHERE datediff('day', p.birth_datetime, v.visit_start_datetime) / 365.25 >= 65""")
def q_filter_age_floor(spark, sf):
    from .dossier import elderly
    r = Roles(spark, sf)
    return elderly(r.person, r.visit_occurrence).drop("visit_occurrence_id", "visit_start_datetime").distinct()


_BASE_COLS = ["visit_occurrence_id", "person_id", "birth_datetime", "death_datetime", "gender_source_value", "race_source_value",
              "ethnicity_source_value", "age"]
_EVENT_COLS = list(dict.fromkeys([*R.CONDITION_COLS, *R.PROCEDURE_COLS, *R.DRUG_COLS]))


def _dossier_sql(kind: str, src: str, fields) -> str:
    shown = ", ".join(f if f in fields else f"NULL AS {f}" for f in _EVENT_COLS)
    keys = ", ".join(f"base.{c}" for c in _BASE_COLS)
    return (f"SELECT {keys}, '{kind}' AS kind, {shown}, count(*) AS n FROM ({src}) s "
            "JOIN base ON s.visit_occurrence_id = base.visit_occurrence_id AND s.person_id = base.person_id GROUP BY ALL")


@register("patient_dossier", cte("person", "visit_occurrence", "condition_occurrence", "procedure_occurrence",
                                 "drug_exposure", "concept") + f"""
, base AS (SELECT v.visit_occurrence_id, p.person_id, p.birth_datetime, p.death_datetime, p.gender_source_value,
             p.race_source_value, p.ethnicity_source_value,
             datediff('day', p.birth_datetime, v.visit_start_datetime) / 365.25 AS age
           FROM person p JOIN visit_occurrence v ON p.person_id = v.person_id
           WHERE datediff('day', p.birth_datetime, v.visit_start_datetime) / 365.25 >= 65)
SELECT {', '.join(_BASE_COLS)}, 'visit' AS kind, {', '.join(f'NULL AS {f}' for f in _EVENT_COLS)}, 1 AS n FROM base
UNION ALL BY NAME {_dossier_sql('condition', _COND_SRC, R.CONDITION_COLS)}
UNION ALL BY NAME {_dossier_sql('procedure', _PROC_SRC, R.PROCEDURE_COLS)}
UNION ALL BY NAME {_dossier_sql('drug', _DRUG_SRC, R.DRUG_COLS)}""")
def q_patient_dossier(spark, sf):
    r = Roles(spark, sf)
    return patient_dossier(r.person, r.visit_occurrence, r.condition_occurrence, r.procedure_occurrence,
                           r.drug_exposure, r.concept, procedure_vocabulary="PROMO")


# ------------------------------------------------------------- features

_CC_SQL = (f"SELECT visit_occurrence_id, {_clean_sql('chief_complaint', 'CCTBL_', False)} AS feature, "
           "count(*) AS value FROM diagnosis_extract GROUP BY 1, 2")


@register("features_chief_complaint", cte("diagnosis_extract") + _CC_SQL)
def q_features_chief_complaint(spark, sf):
    return FE.category_counts(Roles(spark, sf).diagnosis_extract, "chief_complaint", "CCTBL_")


@register("features_chief_complaint_wide", cte("diagnosis_extract") + "SELECT visit_occurrence_id, " + ", ".join(
    f"CAST(count_if(chief_complaint = '{v}') AS BIGINT) AS CCTBL_{v}" for v in CC_VALUES)
    + " FROM diagnosis_extract GROUP BY 1")
def q_features_chief_complaint_wide(spark, sf):
    return FE.pivot_counts(Roles(spark, sf).diagnosis_extract, "chief_complaint", "CCTBL_", CC_VALUES)


_PATTERN = FE.ICD_PATTERN
_LEVELS = ", ".join(str(i) for i in FE.ICD_LEVELS)


def _levels_sql(out: str, events: str) -> str:
    """CTEs counting (visit, level, feature) and keeping each feature at its lowest level."""
    return f"""
, {out}_e AS ({events})
, {out}_c AS (SELECT visit_occurrence_id, level, feature, count(*) AS value FROM {out}_e GROUP BY 1, 2, 3)
, {out}_f AS (SELECT feature, min(level) AS level FROM {out}_c GROUP BY 1)
, {out} AS (SELECT c.visit_occurrence_id, c.feature, c.value FROM {out}_c c
            JOIN {out}_f f ON c.feature = f.feature AND c.level = f.level)
"""


_ICD_NAME = ("CASE WHEN regexp_matches(condition_source_value, '" + _PATTERN + "') "
             "THEN substring(upper(condition_source_value), 1, lv) ELSE upper(condition_source_value) END")
_ICD_SQL = _levels_sql("icd", f"""SELECT visit_occurrence_id, lv AS level, {_clean_sql(_ICD_NAME, 'DETBL_', True)} AS feature
        FROM (SELECT visit_occurrence_id, condition_source_value, unnest([{_LEVELS}]) AS lv FROM diagnosis_extract)""")


@register("features_icd_levels", cte("diagnosis_extract") + _ICD_SQL + "SELECT * FROM icd")
def q_features_icd_levels(spark, sf):
    return FE.code_level_counts(Roles(spark, sf).diagnosis_extract)


_ATC_SQL = _levels_sql("atc", "\nUNION ALL\n".join(
    f"SELECT m.visit_occurrence_id, {i} AS level, {_clean_sql(f'ATC_{i}', 'MEDTBL_', True)} AS feature "
    f"FROM medications m JOIN medication_classification k ON m.drug_concept_id = k.drug_concept_id"
    for i in range(1, 5)))


@register("features_atc", cte("medications", "medication_classification") + _ATC_SQL + "SELECT * FROM atc")
def q_features_atc(spark, sf):
    r = Roles(spark, sf)
    return FE.class_level_counts(r.medications, ["ATC_1", "ATC_2", "ATC_3", "ATC_4"], classes=r.medication_classification,
                                 on="drug_concept_id")


_UT_SQL = (f"SELECT visit_occurrence_id, {_clean_sql('substance', 'UTTBL_', False)} AS feature, count(*) AS value "
           "FROM lab_flag WHERE lower(is_positive) = 'true' GROUP BY 1, 2")
_BC_SQL = (f"SELECT visit_occurrence_id, {_clean_sql('substance', 'BCTBL_', False)} AS feature, count(*) AS value "
           "FROM lab_flag WHERE lower(is_positive) = 'false' GROUP BY 1, 2")
_ACH_SQL = ("SELECT visit_occurrence_id, 'ACHTBL_alcohol_positive' AS feature, count(*) AS value "
            "FROM lab_flag WHERE lower(is_positive) = 'true' GROUP BY 1")


@register("features_toxicology", cte("lab_flag") + _UT_SQL)
def q_features_toxicology(spark, sf):
    return FE.flag_counts(Roles(spark, sf).lab_flag, "is_positive", "substance", "UTTBL_", True)


@register("features_culture", cte("lab_flag") + _BC_SQL)
def q_features_culture(spark, sf):
    return FE.flag_counts(Roles(spark, sf).lab_flag, "is_positive", "substance", "BCTBL_", False)


@register("features_alcohol", cte("lab_flag") + _ACH_SQL)
def q_features_alcohol(spark, sf):
    return FE.flag_total(Roles(spark, sf).lab_flag, "is_positive", "alcohol_positive")


@register("features_measure_passthrough", cte("measurement") + """
, w AS (SELECT visit_occurrence_id, count(*) AS n_measurements, round(avg(value_as_number), 6) AS mean_value,
          max(CASE WHEN measurement_source_value = 'R' THEN value_as_number END) AS max_returned FROM measurement GROUP BY 1)
SELECT visit_occurrence_id, 'METBL_n_measurements' AS feature, CAST(n_measurements AS DOUBLE) AS value FROM w
UNION ALL SELECT visit_occurrence_id, 'METBL_mean_value', coalesce(mean_value, 0.0) FROM w
UNION ALL SELECT visit_occurrence_id, 'METBL_max_returned', coalesce(max_returned, 0.0) FROM w""")
def q_features_measure_passthrough(spark, sf):
    from .phenotype import measure_extract
    return FE.numeric_passthrough(measure_extract(Roles(spark, sf).measurement))


@register("features_binarize", cte("diagnosis_extract") + _ICD_SQL
          + "SELECT visit_occurrence_id, feature, CAST(value >= 1 AS INT) AS value FROM icd")
def q_features_binarize(spark, sf):
    return FE.binarize(FE.code_level_counts(Roles(spark, sf).diagnosis_extract))


@register("features_drop_rare", cte("diagnosis_extract") + _ICD_SQL + """
, b AS (SELECT visit_occurrence_id, feature, CAST(value >= 1 AS INT) AS value FROM icd)
SELECT * FROM b WHERE feature NOT IN (SELECT feature FROM b GROUP BY 1 HAVING sum(value) < 100 AND feature LIKE 'DETBL_%')""")
def q_features_drop_rare(spark, sf):
    return FE.drop_rare(FE.binarize(FE.code_level_counts(Roles(spark, sf).diagnosis_extract)), 100, "DETBL_")


_ALL_FAMILIES_SQL = (_ICD_SQL + _ATC_SQL
                     + f"""
, fam AS (SELECT visit_occurrence_id, feature, CAST(value AS DOUBLE) AS value FROM icd
  UNION ALL SELECT visit_occurrence_id, feature, CAST(value AS DOUBLE) FROM atc
  UNION ALL SELECT visit_occurrence_id, feature, CAST(value AS DOUBLE) FROM ({_CC_SQL})
  UNION ALL SELECT visit_occurrence_id, feature, CAST(value AS DOUBLE) FROM ({_UT_SQL})
  UNION ALL SELECT visit_occurrence_id, feature, CAST(value AS DOUBLE) FROM ({_BC_SQL})
  UNION ALL SELECT visit_occurrence_id, feature, CAST(value AS DOUBLE) FROM ({_ACH_SQL}))
, b AS (SELECT visit_occurrence_id, feature, CAST(value >= 1 AS INT) AS value FROM fam
        WHERE visit_occurrence_id IN (SELECT visit_occurrence_id FROM targets))
, fm AS (SELECT * FROM b WHERE feature NOT IN (SELECT feature FROM b GROUP BY 1 HAVING sum(value) < 100 AND feature LIKE 'DETBL_%'))
""")
_FM_CTE = cte("diagnosis_extract", "medications", "medication_classification", "lab_flag", "targets")


@register("feature_matrix", _FM_CTE + _ALL_FAMILIES_SQL + "SELECT * FROM fm")
def q_feature_matrix(spark, sf):
    r = Roles(spark, sf)
    return FE.feature_matrix(families(r, r.targets))


@register("features_family_counts", _FM_CTE + _ALL_FAMILIES_SQL + """
SELECT split_part(feature, '_', 1) || '_' AS family, count(DISTINCT feature) AS n_features FROM fm GROUP BY 1""")
def q_features_family_counts(spark, sf):
    r = Roles(spark, sf)
    return FE.family_counts(FE.feature_matrix(families(r, r.targets)))


_TARGETS_SQL = """
, t AS (SELECT visit_occurrence_id,
          CASE WHEN arg_min(fulfilled, recorded_at) FILTER (WHERE fulfilled IS NOT NULL) = 'yes' THEN 1 ELSE 0 END AS fulfilled,
          CASE WHEN arg_min(urgent, recorded_at) FILTER (WHERE urgent IS NOT NULL) = 'yes' THEN 1 ELSE 0 END AS urgent
        FROM targets GROUP BY 1)
"""


@register("io_targets", cte("targets") + _TARGETS_SQL + "SELECT visit_occurrence_id, CAST(fulfilled AS INT) AS fulfilled, CAST(urgent AS INT) AS urgent FROM t")
def q_io_targets(spark, sf):
    return load_targets(Roles(spark, sf).targets, "visit_occurrence_id", "recorded_at")


@register("target_counts", cte("targets") + _TARGETS_SQL + """
SELECT 'fulfilled' AS target, CAST(sum(fulfilled) AS BIGINT) AS positives FROM t
UNION ALL SELECT 'urgent', CAST(sum(urgent) AS BIGINT) FROM t""")
def q_target_counts(spark, sf):
    t = load_targets(Roles(spark, sf).targets, "visit_occurrence_id", "recorded_at")
    return FE.target_counts(t)


@register("features_assemble", cte("diagnosis_extract", "lab_flag", "visit_occurrence") + f"""
, fam AS ({_CC_SQL} UNION ALL {_ACH_SQL})
SELECT v.visit_occurrence_id, """ + ", ".join(
    f"CAST(coalesce(sum(CASE WHEN feature = 'CCTBL_{c}' THEN value END), 0) AS DOUBLE) AS CCTBL_{c}" for c in CC_VALUES)
    + """, CAST(coalesce(sum(CASE WHEN feature = 'ACHTBL_alcohol_positive' THEN value END), 0) AS DOUBLE) AS ACHTBL_alcohol_positive
FROM visit_occurrence v LEFT JOIN fam ON v.visit_occurrence_id = fam.visit_occurrence_id GROUP BY 1""")
def q_features_assemble(spark, sf):
    from .phenotype import assemble_wide
    r = Roles(spark, sf)
    fams = [FE.category_counts(r.diagnosis_extract, "chief_complaint", "CCTBL_"),
            FE.flag_total(r.lab_flag, "is_positive", "alcohol_positive")]
    return assemble_wide(r.visit_occurrence, fams, [f"CCTBL_{c}" for c in CC_VALUES] + ["ACHTBL_alcohol_positive"])


@register("fn_code_prefix", cte("diagnosis_extract") + f"""
SELECT visit_occurrence_id, diagnosis_seq, condition_source_value,
  CASE WHEN regexp_matches(condition_source_value, '{_PATTERN}') THEN substring(upper(condition_source_value), 1, 3)
       ELSE upper(condition_source_value) END AS code_prefix
FROM diagnosis_extract""")
def q_fn_code_prefix(spark, sf):
    d = Roles(spark, sf).diagnosis_extract
    return d.select("visit_occurrence_id", "diagnosis_seq", "condition_source_value",
                    FE.code_prefix("condition_source_value", 3).alias("code_prefix"))


@register("phenotype_table", _FM_CTE + _ALL_FAMILIES_SQL + _TARGETS_SQL.replace("\n, t AS", ", t AS") + """
, vis AS (SELECT o_orderkey AS visit_occurrence_id, o_custkey AS person_id,
          CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate + INTERVAL '1' HOUR * CAST(o_orderkey % 100 AS INT) END AS visit_end_datetime
          FROM orders WHERE o_custkey % 9 <> 0)
, per AS (SELECT c_custkey AS person_id, DATE '1930-01-01' + CAST(c_custkey * 7919 % 25000 AS INT) AS birth_datetime FROM customer)
, nf AS (SELECT visit_occurrence_id, CAST(sum(value) AS BIGINT) AS n_features FROM fm GROUP BY 1)
SELECT t.visit_occurrence_id, CAST(t.fulfilled AS INT) AS fulfilled, CAST(t.urgent AS INT) AS urgent,
       CAST(year(vis.visit_end_datetime) - year(per.birth_datetime) AS INTEGER) AS age, coalesce(nf.n_features, 0) AS n_features
FROM t LEFT JOIN vis ON t.visit_occurrence_id = vis.visit_occurrence_id
LEFT JOIN per ON vis.person_id = per.person_id
LEFT JOIN nf ON t.visit_occurrence_id = nf.visit_occurrence_id""")
def q_phenotype_table(spark, sf):
    r = Roles(spark, sf)
    return phenotype_table(r)


@register("rank_features_by_support", _FM_CTE + _ALL_FAMILIES_SQL + """
SELECT feature AS Feature, CAST(sum(value) AS BIGINT) AS Total,
       CAST(row_number() OVER (ORDER BY sum(value) DESC, feature DESC) AS INTEGER) AS Rank
FROM fm GROUP BY 1 QUALIFY Rank <= 150""")
def q_rank_features_by_support(spark, sf):
    from ..operators.sampling import rank_features
    r = Roles(spark, sf)
    fm = FE.feature_matrix(families(r, r.targets))
    votes = fm.groupBy(F.col("feature").alias("Feature")).agg(F.sum("value").cast("bigint").alias("Total"))
    return rank_features(votes, 150)


@register("join_rollups_two_keys", cte("procedure_occurrence", "drug_exposure", "visit_occurrence", "concept") + f"""
, pr AS (SELECT visit_occurrence_id, person_id, count(*) AS n_procedures FROM ({_PROC_SRC}) GROUP BY ALL)
, d AS (SELECT visit_occurrence_id, person_id, count(*) AS n_drugs FROM ({_DRUG_SRC}) GROUP BY ALL)
SELECT v.visit_occurrence_id, v.person_id, n_procedures, n_drugs
FROM visit_occurrence v LEFT JOIN pr ON v.visit_occurrence_id = pr.visit_occurrence_id AND v.person_id = pr.person_id
LEFT JOIN d ON v.visit_occurrence_id = d.visit_occurrence_id AND v.person_id = d.person_id""")
def q_join_rollups_two_keys(spark, sf):
    from ..operators.joins import join_frames
    r = Roles(spark, sf)
    keys = list(R.KEYS)
    p = R.rollup_counts(R.rollup_procedures(r.procedure_occurrence, r.concept, "PROMO"), keys, "n_procedures")
    d = R.rollup_counts(R.rollup_drugs(r.drug_exposure, r.concept), keys, "n_drugs")
    return join_frames([r.visit_occurrence.select(*keys), p, d], keys, "left")
