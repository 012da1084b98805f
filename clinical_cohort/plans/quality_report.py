"""Cohort quality report - main cohort against its comparison sample.

Numeric columns get the pooled t-test, categorical columns the chi-square
test on main's categories; every p-value gets significance stars and a
Benjamini-Hochberg adjustment across all tests of the report. The work is
two aggregations per frame (moments, category counts); the per-test result
has one row per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as Q


def cohort_quality_report(main: DataFrame, sample: DataFrame, numeric: Sequence[str] | None = None,
                          categorical: Sequence[str] | None = None) -> DataFrame:
    """-> (Column, Test, statistic, dof, p, p_adj, stars).

    Without explicit lists, numeric and string columns are chosen from the
    schema (Q7 kinds).
    """
    if numeric is None:
        numeric = [f.name for f in main.schema.fields if Q.column_kind(f.dataType) == "numerical"]
    if categorical is None:
        categorical = [f.name for f in main.schema.fields if Q.column_kind(f.dataType) == "string"]
    parts = []
    if numeric:
        t = Q.ttest(main, sample, numeric)
        parts.append(t.select("Column", F.lit("t-test").alias("Test"), F.col("t").alias("statistic"),
                              "dof", "p"))
    if categorical:
        c = Q.chisq(main, sample, categorical)
        parts.append(c.select("Column", F.lit("chi-square").alias("Test"), F.col("chi2").alias("statistic"),
                              "dof", "p"))
    if not parts:
        raise ValueError("no column to test")
    tests = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # One row per compared column: bounded by the schema, one window suffices.
    return Q.fdr_bh(tests, "p").withColumn("stars", Q.significance("p"))
