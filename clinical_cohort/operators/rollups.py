"""Per-visit roll-ups of coded events.

A roll-up is long: one row per group and distinct event with its number ``n``.
Fields of one event stay aligned (D23), repeats are merged, and a visit of any
size spreads over partitions, as the events are part of the grouping key. One
array per group exists only for export (``collect_items``): its size is that of
one visit's distinct events.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import active_at_visit, decode

KEYS = ("visit_occurrence_id", "person_id")
CONDITION_COLS = ("condition_concept_id", "condition_source_value", "concept_name", "vocabulary_id", "domain_id",
                  "concept_class_id", "concept_code")
PROCEDURE_COLS = ("procedure_concept_id", "procedure_datetime", "procedure_source_value", "concept_name", "vocabulary_id",
                  "concept_code")
DRUG_COLS = ("drug_concept_id", "concept_name", "vocabulary_id", "drug_generic_source_value_name",
             "drug_exposure_start_datetime", "drug_exposure_end_datetime", "route_source_value")


def rollup(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``keys, cols, n``, a row per distinct event of a group; null keys and fields are kept."""
    if not keys:
        raise ValueError("rollup needs at least one key column")
    return df.groupBy(*keys, *cols).agg(F.count(F.lit(1)).alias("n"))


def rollup_counts(rolled: DataFrame, keys: Sequence[str], name: str = "n_items") -> DataFrame:
    """Number of events per group of a roll-up, one row per group."""
    return rolled.groupBy(*keys).agg(F.sum("n").alias(name))


def collect_items(rolled: DataFrame, keys: Sequence[str], cols: Sequence[str], name: str = "items") -> DataFrame:
    """``keys, n_items, name``: one row per group with a sorted array of its distinct events and their number.

    For export (IO9) only; the array holds one group's distinct events.
    """
    item = F.struct(*[F.col(c) for c in [*cols, "n"]])
    return rolled.groupBy(*keys).agg(F.sum("n").alias("n_items"), F.array_sort(F.collect_list(item)).alias(name))


def items_text(items: str | Column, fields: Sequence[str], sep: str = "|", item_sep: str = ";") -> Column:
    """M9 for arrays of structs: 'f1|f2;f1|f2' with nulls as empty text."""
    c = F.col(items) if isinstance(items, str) else items
    return F.array_join(F.transform(c, lambda x: F.concat_ws(
        sep, *[F.coalesce(x[f].cast("string"), F.lit("")) for f in fields])), item_sep)


def _decoded(events: DataFrame, concept: DataFrame, concept_id: str, cols: Sequence[str]) -> DataFrame:
    """Events joined to the concept columns among ``cols`` that they do not have themselves."""
    return decode(events, concept, concept_id, concept_cols=[c for c in cols if c not in events.columns])


def rollup_conditions(conditions: DataFrame, visits: DataFrame, concept: DataFrame, open_ended: bool = False,
                      cols: Sequence[str] = CONDITION_COLS, keys: Sequence[str] = KEYS) -> DataFrame:
    """A5: conditions active at their visit's start, decoded."""
    active = active_at_visit(conditions, visits, open_ended=open_ended)
    return rollup(_decoded(active, concept, "condition_concept_id", cols), keys, cols)


def rollup_procedures(procedures: DataFrame, concept: DataFrame, vocabulary: str = "CPT4",
                      cols: Sequence[str] = PROCEDURE_COLS, keys: Sequence[str] = KEYS) -> DataFrame:
    """Procedures of one vocabulary, decoded, by the event's own person."""
    vocab = concept.where(F.col("vocabulary_id") == vocabulary)
    return rollup(_decoded(procedures, vocab, "procedure_concept_id", cols), keys, cols)


def rollup_drugs(drugs: DataFrame, concept: DataFrame, cols: Sequence[str] = DRUG_COLS,
                 keys: Sequence[str] = KEYS) -> DataFrame:
    """Drug exposures, decoded, by the event's own person."""
    return rollup(_decoded(drugs, concept, "drug_concept_id", cols), keys, cols)


def rollup_by(df: DataFrame, keys: Sequence[str], type_col: str, cols: Sequence[str]) -> DataFrame:
    """Roll-up with the event's source/type as an extra key."""
    return rollup(df, [*keys, type_col], cols)


def rollup_observations(observations: DataFrame, concept: DataFrame, search: Sequence[str] = (),
                        concept_id: str = "observation_concept_id", keys: Sequence[str] = ("visit_occurrence_id",),
                        cols: Sequence[str] = ("concept_name", "observation_source_value")) -> DataFrame:
    """Decoded observations; with ``search`` only those whose concept name contains one of the texts."""
    from .filters import contains_any
    decoded = _decoded(observations, concept, concept_id, cols)
    if search:
        decoded = decoded.where(contains_any("concept_name", list(search)))
    return rollup(decoded, keys, cols)


def count_by_type(df: DataFrame, keys: Sequence[str], type_col: str) -> DataFrame:
    """Number of events per group and type."""
    return df.groupBy(*keys, type_col).agg(F.count(F.lit(1)).alias("n_events"))


def outcomes(visits: DataFrame, person: DataFrame, disposition: str = "discharge_to_source_value",
             death: str = "death_datetime") -> DataFrame:
    """Per visit the disposition, death during or after the visit, length of stay."""
    from ..functions.dates import visit_length
    p = person.select("person_id", death)
    v = visits.select("visit_occurrence_id", "person_id", "visit_start_datetime", "visit_end_datetime", disposition)
    j = v.join(p, "person_id", "left")
    return j.select("visit_occurrence_id", "person_id", F.col(disposition).alias("disposition"),
                    F.when(F.col(death).isNull(), 0).when(
                        F.col(death) >= F.to_date("visit_start_datetime"), 1).otherwise(0).alias("died"),
                    visit_length("visit_start_datetime", "visit_end_datetime").alias("length_of_stay"))
