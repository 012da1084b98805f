"""Phenotype feature matrix and table.

Families (long form) -> union -> restricted to the target visits ->
binarised -> rare diagnosis features dropped (A19). The phenotype table
joins the targets (IO5) with age by calendar year (M6) and the number of
present features per visit; the long matrix itself feeds selection and
models (sparse vectors, ``operators.selection``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import age_by_year
from ..operators import features as FE
from ..sources.files import load_targets

# Chief-complaint categories of the test tables (return flag + line status).
CC_VALUES = ["AF", "AO", "NF", "NO", "RF", "RO"]
ATC_LEVELS = ["ATC_1", "ATC_2", "ATC_3", "ATC_4"]


def families(r, base: DataFrame | None = None) -> dict[str, DataFrame]:
    """The six feature families of the reference over the role views ``r``, of the visits of ``base`` if given."""
    out = {
        "DETBL_": FE.code_level_counts(r.diagnosis_extract, base=base),
        "MEDTBL_": FE.class_level_counts(r.medications, ATC_LEVELS, classes=r.medication_classification, on="drug_concept_id", base=base),
        "CCTBL_": FE.category_counts(r.diagnosis_extract, "chief_complaint", "CCTBL_"),
        "UTTBL_": FE.flag_counts(r.lab_flag, "is_positive", "substance", "UTTBL_", True),
        "BCTBL_": FE.flag_counts(r.lab_flag, "is_positive", "substance", "BCTBL_", False),
        "ACHTBL_": FE.flag_total(r.lab_flag, "is_positive", "alcohol_positive"),
    }
    if base is None:
        return out
    return {p: f if p in ("DETBL_", "MEDTBL_") else FE.restrict_keys(f, base) for p, f in out.items()}


def measure_extract(measurement: DataFrame) -> DataFrame:
    """A per-visit numeric table (count, mean value, max returned value)."""
    return measurement.groupBy("visit_occurrence_id").agg(
        F.count(F.lit(1)).alias("n_measurements"),
        F.round(F.avg("value_as_number"), 6).alias("mean_value"),
        F.max(F.when(F.col("measurement_source_value") == "R", F.col("value_as_number"))).alias("max_returned"))


def assemble_wide(base: DataFrame, families_long: Sequence[DataFrame], features: Sequence[str],
                  key: str = "visit_occurrence_id") -> DataFrame:
    """Wide matrix for the base visits: union of long families, one pivot, zero fill."""
    long_df = families_long[0].select(key, "feature", F.col("value").cast("double"))
    for f in families_long[1:]:
        long_df = long_df.unionByName(f.select(key, "feature", F.col("value").cast("double")))
    wide = FE.to_wide(long_df, features, key)
    out = base.select(key).distinct().join(wide, key, "left")
    return out.select(key, *[F.coalesce(F.col(FE.quoted(n)), F.lit(0.0)).alias(n) for n in features])


def phenotype_table(r) -> DataFrame:
    """(visit, targets..., age, n_features) for every target visit."""
    targets = load_targets(r.targets, "visit_occurrence_id", "recorded_at")
    fm = FE.feature_matrix(families(r, r.targets))
    nf = fm.groupBy("visit_occurrence_id").agg(F.sum("value").cast("bigint").alias("n_features"))
    v = r.visit_occurrence.select("visit_occurrence_id", "person_id", "visit_end_datetime")
    p = r.person.select("person_id", "birth_datetime")
    age = v.join(p, "person_id", "left").select("visit_occurrence_id",
                                                age_by_year("visit_end_datetime", "birth_datetime").alias("age"))
    out = targets.join(age, "visit_occurrence_id", "left").join(nf, "visit_occurrence_id", "left")
    return out.select("visit_occurrence_id", "fulfilled", "urgent", "age",
                      F.coalesce("n_features", F.lit(0).cast("bigint")).alias("n_features"))
