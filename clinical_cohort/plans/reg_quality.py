"""Registered queries: profiling and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.sampling import comparison_sample, top_values
from .quality_report import cohort_quality_report
from .registry import ORACLES, register
from .roles import Roles, cte

PERSON_COLS = ["person_id", "birth_datetime", "death_datetime", "gender_source_value", "race_source_value",
               "ethnicity_source_value", "care_site_id", "location_id"]
CATEGORICAL = ["gender_source_value", "race_source_value", "ethnicity_source_value", "care_site_id"]
NUMERIC = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]
# Profiling regexes (age and name patterns as in the
# reference's profiling driver, plus a segment pattern for this table).
PATTERNS = {
    "gender_source_value": "^M(ale)?$|^F(emale)?$",
    "ethnicity_source_value": "^[a-zA-Z]*$",
    "race_source_value": "^[A-Z]+$",
}
SAMPLE_N = 1000
SAMPLE_KEYS = ["visit_occurrence_id", "l_linenumber", "measurement_concept_id", "l_suppkey"]
TEST_COLS = ["value_as_number", "l_linenumber"]
CHI_COLS = ["measurement_source_value", "l_linenumber"]


def _union_sql(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _empty_sql(c: str) -> str:
    return f"({c} IS NULL OR CAST({c} AS VARCHAR) = '')"


def _pct_sql(num: str, den: str) -> str:
    return f"round(CAST({num} AS DOUBLE) * 100.0 / CAST({den} AS DOUBLE), 6)"


@register("qc_null_pct", cte("person") + _union_sql([
    f"SELECT '{c}' AS \"Column\", CAST(count_if({_empty_sql(c)}) AS BIGINT) AS NullCount, count(*) AS RowCount, "
    f"{_pct_sql(f'count_if({_empty_sql(c)})', 'count(*)')} AS NullPercentage FROM person" for c in PERSON_COLS]), digits=6)
def q_null_pct(spark, sf):
    return Q.null_percentage(Roles(spark, sf).person, PERSON_COLS)


@register("qc_numeric_summary", _union_sql([
    f"SELECT '{c}' AS \"Column\", count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 6) AS mean, "
    f"round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
    f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50, "
    f"quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"
    for c in NUMERIC]), digits=6)
def q_numeric_summary(spark, sf):
    return Q.numeric_summary(Roles(spark, sf).table("lineitem"), NUMERIC, exact=True)


@register("qc_distinct_counts", cte("person") + _union_sql([
    f"SELECT '{c}' AS \"Column\", CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) "
    f"AS DistinctCount FROM person" for c in PERSON_COLS]))
def q_distinct_counts(spark, sf):
    return Q.distinct_counts(Roles(spark, sf).person, PERSON_COLS)


_DIST_SQL = cte("person") + _union_sql([
    f"SELECT '{c}' AS \"Column\", CAST({c} AS VARCHAR) AS Value, count(*) AS Count FROM person GROUP BY 2"
    for c in CATEGORICAL])


@register("qc_distribution", _DIST_SQL)
def q_distribution(spark, sf):
    return Q.value_distribution(Roles(spark, sf).person, CATEGORICAL)


@register("topk_values", _DIST_SQL)
def q_topk_values(spark, sf):
    return top_values(Q.value_distribution(Roles(spark, sf).person, CATEGORICAL))


@register("qc_distribution_pct", cte("person") + ", d AS (" + _union_sql([
    f"SELECT '{c}' AS \"Column\", CAST({c} AS VARCHAR) AS Value, count(*) AS Count FROM person GROUP BY 2"
    for c in CATEGORICAL]) + """)
SELECT d."Column", Value, Count, round(CAST(Count AS DOUBLE) * 100.0 / CAST(sum(Count) OVER (PARTITION BY d."Column") AS DOUBLE), 6) AS Percent
FROM d""", digits=6)
def q_distribution_pct(spark, sf):
    return Q.value_distribution_pct(Roles(spark, sf).person, CATEGORICAL)


@register("qc_regex_mismatch", cte("person") + _union_sql([
    f"SELECT '{c}' AS \"Column\", '{p}' AS Pattern, CAST(count_if(NOT regexp_matches(CAST({c} AS VARCHAR), '{p}')) AS BIGINT) AS MismatchCount, "
    f"CAST(count_if({c} IS NULL) AS BIGINT) AS NullCount, count(*) AS RowCount, "
    f"{_pct_sql(f'count_if(NOT regexp_matches(CAST({c} AS VARCHAR), {chr(39)}{p}{chr(39)}))', 'count(*)')} AS MismatchPercentage "
    f"FROM person" for c, p in PATTERNS.items()]), digits=6)
def q_regex_mismatch(spark, sf):
    return Q.mismatch_percentage(Roles(spark, sf).person, PATTERNS)


# Spark type names and kinds of the person role (fixed by the role view).
_PERSON_TYPES = [("person_id", "bigint", "numerical"), ("birth_datetime", "date", "date"),
                 ("death_datetime", "date", "date"), ("gender_source_value", "string", "string"),
                 ("race_source_value", "string", "string"), ("ethnicity_source_value", "string", "string"),
                 ("care_site_id", "bigint", "numerical"), ("location_id", "bigint", "numerical")]


@register("qc_column_types", cte("person") + _union_sql([
    f"SELECT '{c}' AS \"Column\", '{t}' AS Type, '{k}' AS Kind, count({c}) AS NonNullCount, "
    f"count(DISTINCT {c}) AS DistinctCount FROM person" for c, t, k in _PERSON_TYPES]))
def q_column_types(spark, sf):
    return Q.column_types(Roles(spark, sf).person)


def _sample(r: Roles):
    m = r.measurement
    return m, comparison_sample(m, SAMPLE_N, SAMPLE_KEYS, tiebreak=m.columns)


_HASH4 = ("md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in SAMPLE_KEYS)
          + ", '42'))")
_SAMPLE_CTE = (cte("measurement") + f", smp AS (SELECT * FROM measurement ORDER BY {_HASH4}, "
               "visit_occurrence_id, measurement_concept_id, measurement_source_value, measurement_datetime, "
               f"value_as_number, l_linenumber, l_suppkey LIMIT {SAMPLE_N})\n")


def _moments_sql(src: str, tag: str) -> str:
    return _union_sql([
        f"SELECT '{c}' AS col, count({c}) AS n{tag}, avg(CAST({c} AS DOUBLE)) AS mean{tag}, "
        f"var_samp(CAST({c} AS DOUBLE)) AS var{tag}, stddev_pop(CAST({c} AS DOUBLE)) AS std{tag} FROM {src}"
        for c in TEST_COLS])


@register("qc_ttest_stats", _SAMPLE_CTE + f", a AS ({_moments_sql('measurement', '1')}), b AS ({_moments_sql('smp', '2')})"
          + """
, j AS (SELECT a.col, n1, mean1, var1, std1, n2, mean2, var2, std2,
               CAST(n1 + n2 - 2 AS DOUBLE) AS dof,
               ((n1 - 1) * var1 + (n2 - 1) * var2) / CAST(n1 + n2 - 2 AS DOUBLE) AS sp2
        FROM a JOIN b ON a.col = b.col)
SELECT col AS "Column", n1, round(mean1, 6) AS mean1, round(std1, 6) AS std1, n2, round(mean2, 6) AS mean2,
       round(std2, 6) AS std2,
       CASE WHEN n1 >= 2 AND n2 >= 2 AND sp2 > 0 THEN round((mean1 - mean2) / sqrt(sp2 * (1.0 / n1 + 1.0 / n2)), 6) END AS t,
       CASE WHEN n1 >= 2 AND n2 >= 2 AND sp2 > 0 THEN CAST(dof AS BIGINT) END AS dof
FROM j""", digits=6)
def q_ttest_stats(spark, sf):
    main, smp = _sample(Roles(spark, sf))
    return Q.ttest_stats(main, smp, TEST_COLS)


def _p_sql(rows: str, kind: str) -> str:
    """``rows`` with the tail probability ``p`` of its statistic, by Simpson's rule over 4 000 steps."""
    if kind == "t":  # two-sided: 1 - 2 * integral of the density from 0 to |t|
        top, sides = "abs(t)", 2
        density = ("exp(lgamma((dof + 1) / 2.0) - lgamma(dof / 2.0)) / sqrt(dof * pi()) "
                   "* pow(1 + u * u / dof, -(dof + 1) / 2.0)")
    else:  # upper tail, over u = sqrt(x) so that one degree of freedom has no pole
        top, sides = "sqrt(chi2)", 1
        density = "2 * pow(u, dof - 1) * exp(-u * u / 2 - lgamma(dof / 2.0)) / pow(2, dof / 2.0)"
    return f"""SELECT s.*, greatest(1 - {sides} * area, 0.0) AS p FROM ({rows}) s LEFT JOIN (
  SELECT "Column", sum((CASE WHEN k IN (0, 4000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * {density}) * max(h) / 3 AS area
  FROM (SELECT *, {top} / 4000 AS h, k * {top} / 4000 AS u FROM ({rows}), (SELECT unnest(generate_series(0, 4000)) AS k))
  WHERE u IS NOT NULL GROUP BY 1) i ON s."Column" = i."Column\""""


def _fdr_sql(tests: str, columns: str) -> str:
    """Benjamini-Hochberg over the p of ``tests``, rounded."""
    return f"""SELECT {columns}, round(p, 6) AS p,
  round(least(min(p * m / i) OVER (ORDER BY p, o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1.0), 6) AS p_adj
FROM (SELECT *, row_number() OVER (ORDER BY p, o) AS i, count(*) OVER () AS m
      FROM (SELECT *, row_number() OVER () AS o FROM ({tests})) WHERE p IS NOT NULL)
UNION ALL SELECT {columns}, NULL, NULL FROM ({tests}) WHERE p IS NULL"""


@register("qc_ttest", f"SELECT * REPLACE (round(p, 6) AS p) FROM ({_p_sql(ORACLES['qc_ttest_stats'], 't')})", digits=6)
def q_ttest(spark, sf):
    main, smp = _sample(Roles(spark, sf))
    return Q.ttest(main, smp, TEST_COLS)


def _cells_sql(src: str, name: str) -> str:
    return _union_sql([f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS val, count(*) AS {name} FROM {src} "
                       f"WHERE {c} IS NOT NULL GROUP BY 2" for c in CHI_COLS])


_CONTINGENCY_SQL = (_SAMPLE_CTE + f", a AS ({_cells_sql('measurement', 'Notes')}), b AS ({_cells_sql('smp', 'Rand')})"
                    + """
, t AS (SELECT a.col AS "Column", a.val AS Value, CAST(Notes AS BIGINT) AS Notes, CAST(coalesce(Rand, 0) AS BIGINT) AS Rand
        FROM a LEFT JOIN b ON a.col = b.col AND a.val = b.val)
""")


@register("qc_contingency", _CONTINGENCY_SQL + "SELECT * FROM t")
def q_contingency(spark, sf):
    main, smp = _sample(Roles(spark, sf))
    return Q.contingency(main, smp, CHI_COLS)


@register("qc_chisq_stat", _CONTINGENCY_SQL + """
, tot AS (SELECT "Column", sum(Notes) AS c1, sum(Rand) AS c2, count(*) AS k FROM t GROUP BY 1)
, e AS (SELECT t."Column", k, Notes, Rand,
               CAST(Notes + Rand AS DOUBLE) * c1 / CAST(c1 + c2 AS DOUBLE) AS e1,
               CAST(Notes + Rand AS DOUBLE) * c2 / CAST(c1 + c2 AS DOUBLE) AS e2 FROM t JOIN tot USING ("Column"))
, x AS (SELECT "Column", k, e1, e2,
          CASE WHEN k = 2 THEN greatest(abs(Notes - e1) - 0.5, 0.0) ELSE abs(Notes - e1) END AS d1,
          CASE WHEN k = 2 THEN greatest(abs(Rand - e2) - 0.5, 0.0) ELSE abs(Rand - e2) END AS d2 FROM e)
SELECT "Column",
  CASE WHEN max(CASE WHEN e1 = 0 OR e2 = 0 THEN 1 ELSE 0 END) = 0 AND max(k) >= 2
       THEN round(sum(d1 * d1 / e1 + d2 * d2 / e2), 6) END AS chi2,
  CASE WHEN max(CASE WHEN e1 = 0 OR e2 = 0 THEN 1 ELSE 0 END) = 0 AND max(k) >= 2 THEN CAST(max(k) - 1 AS BIGINT) END AS dof
FROM x GROUP BY 1""", digits=6)
def q_chisq_stat(spark, sf):
    main, smp = _sample(Roles(spark, sf))
    return Q.chisq_stats(Q.contingency(main, smp, CHI_COLS))


@register("qc_chisq", f"SELECT * REPLACE (round(p, 6) AS p) FROM ({_p_sql(ORACLES['qc_chisq_stat'], 'chi2')})", digits=6)
def q_chisq(spark, sf):
    main, smp = _sample(Roles(spark, sf))
    return Q.chisq(main, smp, CHI_COLS)


@register("qc_stars", cte("scores") + """
SELECT doc_id, score, CASE WHEN score IS NULL OR isnan(score) THEN NULL WHEN score > 0.05 THEN 'ns'
  WHEN score < 0.0001 THEN '****' WHEN score < 0.001 THEN '***' WHEN score < 0.01 THEN '**' ELSE '*' END AS stars
FROM scores""")
def q_stars(spark, sf):
    s = Roles(spark, sf).scores
    return s.select("doc_id", "score", Q.significance("score").alias("stars"))


@register("qc_fdr", _fdr_sql(f"""SELECT "Column", p FROM ({_p_sql(ORACLES['qc_ttest_stats'], 't')})
  UNION ALL SELECT "Column" || ':chi2', p FROM ({_p_sql(ORACLES['qc_chisq_stat'], 'chi2')})""", '"Column"'), digits=6)
def q_fdr(spark, sf):
    main, smp = _sample(Roles(spark, sf))
    t = Q.ttest(main, smp, TEST_COLS).select("Column", "p")
    c = Q.chisq(main, smp, CHI_COLS).select(F.concat(F.col("Column"), F.lit(":chi2")).alias("Column"), "p")
    return Q.fdr_bh(t.unionByName(c))


@register("qc_fdr_scores", cte("scores") + """
, v AS (SELECT doc_id, label, score FROM scores WHERE score IS NOT NULL AND NOT isnan(score))
, r AS (SELECT *, row_number() OVER (ORDER BY score, doc_id) AS i, count(*) OVER () AS m FROM v)
SELECT doc_id, label, score,
       least(min(score * m / i) OVER (ORDER BY score, doc_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1.0)
         AS p_adj
FROM r
UNION ALL SELECT doc_id, label, score, CAST(NULL AS DOUBLE) FROM scores WHERE score IS NULL OR isnan(score)""")
def q_fdr_scores(spark, sf):
    """Q12 over one p-value per document (a table that grows with the data)."""
    return Q.fdr_bh(Roles(spark, sf).scores, "score")


_PROFILE_NUM = ["care_site_id", "location_id"]
_PROFILE_CAT = ["gender_source_value", "race_source_value", "ethnicity_source_value", "birth_datetime"]


def _profile_sql() -> str:
    cols = list(dict.fromkeys([*_PROFILE_NUM, *_PROFILE_CAT, *PATTERNS]))
    parts = ["SELECT '*' AS \"Column\", 'rows' AS Metric, CAST(count(*) AS DOUBLE) AS Value FROM person"]
    for c in cols:
        parts += [f"SELECT '{c}', 'nulls', CAST(count_if({_empty_sql(c)}) AS DOUBLE) FROM person",
                  f"SELECT '{c}', 'null_pct', {_pct_sql(f'count_if({_empty_sql(c)})', 'count(*)')} FROM person",
                  f"SELECT '{c}', 'distinct', CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) FROM person"]
    for c in _PROFILE_NUM:
        x = f"CAST({c} AS DOUBLE)"
        parts += [f"SELECT '{c}', 'count', CAST(count({c}) AS DOUBLE) FROM person",
                  f"SELECT '{c}', 'mean', round(avg({x}), 6) FROM person",
                  f"SELECT '{c}', 'stddev', round(stddev_samp({x}), 6) FROM person",
                  f"SELECT '{c}', 'min', min({x}) FROM person", f"SELECT '{c}', 'max', max({x}) FROM person",
                  f"SELECT '{c}', 'p25', quantile_cont({x}, 0.25) FROM person",
                  f"SELECT '{c}', 'p50', quantile_cont({x}, 0.5) FROM person",
                  f"SELECT '{c}', 'p75', quantile_cont({x}, 0.75) FROM person"]
    for c, p in PATTERNS.items():
        cnt = f"count_if(NOT regexp_matches(CAST({c} AS VARCHAR), '{p}'))"
        parts += [f"SELECT '{c}', 'mismatch', CAST({cnt} AS DOUBLE) FROM person",
                  f"SELECT '{c}', 'mismatch_pct', {_pct_sql(cnt, 'count(*)')} FROM person"]
    return cte("person") + _union_sql(parts)


@register("qc_profile", _profile_sql(), digits=6)
def q_profile(spark, sf):
    return Q.profile(Roles(spark, sf).person, _PROFILE_NUM, _PROFILE_CAT, PATTERNS, exact=True)


_REPORT_CTE = (cte("measurement") + f", smp AS (SELECT * FROM measurement ORDER BY {_HASH4}, visit_occurrence_id, "
               "measurement_source_value, value_as_number, l_linenumber, measurement_concept_id, l_suppkey "
               f"LIMIT {SAMPLE_N})\n")
_REPORT_T = _p_sql(f"""SELECT * FROM ({ORACLES['qc_ttest_stats'].replace(_SAMPLE_CTE, _REPORT_CTE)})
  WHERE "Column" = 'value_as_number'""", "t")
_REPORT_CHI = _p_sql(f"""SELECT * FROM ({ORACLES['qc_chisq_stat'].replace(_SAMPLE_CTE, _REPORT_CTE)})
  WHERE "Column" IN ('measurement_source_value', 'l_linenumber')""", "chi2")


@register("cohort_quality_report", "SELECT *, CASE WHEN p IS NULL THEN NULL WHEN p > 0.05 THEN 'ns' WHEN p < 0.0001 THEN '****' "
          "WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' ELSE '*' END AS stars FROM ("
          + _fdr_sql(f"""SELECT "Column", 't-test' AS Test, t AS statistic, dof, p FROM ({_REPORT_T})
  UNION ALL SELECT "Column", 'chi-square', chi2, dof, p FROM ({_REPORT_CHI})""", '"Column", Test, statistic, dof') + ")", digits=6)
def q_cohort_quality_report(spark, sf):
    r = Roles(spark, sf)
    m = r.measurement.select("visit_occurrence_id", "measurement_source_value", "value_as_number", "l_linenumber",
                             "measurement_concept_id", "l_suppkey")
    return cohort_quality_report(m, comparison_sample(m, SAMPLE_N, SAMPLE_KEYS, tiebreak=m.columns),
                                 numeric=["value_as_number"], categorical=["measurement_source_value", "l_linenumber"])
