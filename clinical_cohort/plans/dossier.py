"""Elderly patient dossier - demographics of visits at age >= 65 with
their conditions, procedures and drugs.

Long: one row of kind ``visit`` per elderly visit, and one row per distinct
event of each kind. Events are joined to the elderly visits before they are
rolled up, so other visits' events are never grouped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import age_fractional
from ..operators.rollups import rollup_conditions, rollup_drugs, rollup_procedures

PERSON_COLS = ("person_id", "birth_datetime", "death_datetime", "gender_source_value", "race_source_value",
               "ethnicity_source_value")


def elderly(person: DataFrame, visits: DataFrame, min_age: float = 65) -> DataFrame:
    """visits of people aged ``min_age`` or more at the visit (fractional age)."""
    v = visits.select("visit_occurrence_id", "person_id", "visit_start_datetime")
    j = person.select(*PERSON_COLS).join(v, "person_id", "inner")
    j = j.withColumn("age", age_fractional("visit_start_datetime", "birth_datetime"))
    return j.where(F.col("age") >= F.lit(float(min_age)))


def patient_dossier(person: DataFrame, visits: DataFrame, conditions: DataFrame, procedures: DataFrame,
                    drugs: DataFrame, concept: DataFrame, min_age: float = 65,
                    procedure_vocabulary: str = "CPT4") -> DataFrame:
    """Rows of ``kind`` visit, condition, procedure and drug over the elderly visits.

    Every row has the visit's demographics; the fields of other kinds are null.
    """
    keys = ["visit_occurrence_id", "person_id"]
    visited = elderly(person, visits, min_age)
    base = visited.drop("visit_start_datetime")
    demographics = base.columns
    of = lambda events: events.join(base, keys)

    def kind(name: str, rows: DataFrame) -> DataFrame:
        return rows.withColumn("kind", F.lit(name))

    parts = [
        kind("visit", base.withColumn("n", F.lit(1).cast("long"))),
        kind("condition", rollup_conditions(of(conditions), visited, concept, keys=demographics)),
        kind("procedure", rollup_procedures(of(procedures), concept, procedure_vocabulary, keys=demographics)),
        kind("drug", rollup_drugs(of(drugs), concept, keys=demographics)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
