"""Measurement summaries per visit (A1-A4).

One scan of the measurement table, the code filter pushed to the scan, the
vocabulary join, and **one** ``groupBy`` that computes max, min, mean, the
first and the last value together: ``min_by``/``max_by`` over a
``(time, value)`` struct give the value at the earliest/latest time with an
explicit tie-break (smallest value first, largest value last). Partial
aggregation runs map-side, so a visit holding a third of all rows leaves one
row per map task before the single shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .filters import filter_in
from .joins import decode

# The nine vital-sign concept ids the reference pulls by
# default (body weight, diastolic pressure, coma scale, heart rate, mean
# pressure, systolic pressure, corrected QT, temperature, respiratory rate).
VITAL_CODES: tuple[int, ...] = (
    3025315, 3012888, 3032652, 3027018, 3027598, 3024171, 3004249, 3026258, 3020891,
)

SUMMARY_COLUMNS = ("Max_value", "Min_value", "Mean_value")
FIRST_LAST_COLUMNS = ("First_Datetime", "First_Value", "Last_Datetime", "Last_Value")


def select_measurements(
    measurement: DataFrame,
    concept: DataFrame | None = None,
    codes: Sequence[int] | None = None,
    concept_key: str = "measurement_concept_id",
    concept_id: str = "concept_id",
    concept_filter=None,
) -> DataFrame:
    """F9 + J6: keep coded measurements, decoded against the vocabulary.

    ``codes`` filters the measurement table directly (pushed into the scan);
    ``concept_filter`` (a Column) selects codes through vocabulary attributes.
    The inner join with ``concept`` keeps only codes the vocabulary knows.
    """
    if codes:
        measurement = filter_in(measurement, concept_key, list(codes))
    if concept is not None:
        vocab = concept
        if codes:
            vocab = filter_in(vocab, concept_id, list(codes))
        if concept_filter is not None:
            vocab = vocab.where(concept_filter)
        measurement = decode(measurement, vocab.select(concept_id), concept_key, concept_id, concept_cols=[])
    return measurement


def measurement_summary(
    vitals: DataFrame,
    keys: Sequence[str] = ("visit_occurrence_id", "measurement_source_value"),
    value: str = "value_as_number",
    time: str = "measurement_datetime",
    first_last: bool = True,
    summary: bool = True,
    round_mean: int | None = None,
) -> DataFrame:
    """A1 + A2: one aggregation with max/min/mean and first/last value and time.

    Null keys form their own group (D7); ties on the first/last time are
    broken by value (D6) so each group yields exactly one row.
    """
    aggs = []
    if summary:
        mean = F.avg(value)
        if round_mean is not None:
            mean = F.round(mean, round_mean)
        aggs += [F.max(value).alias("Max_value"), F.min(value).alias("Min_value"), mean.alias("Mean_value")]
    if first_last:
        tv = F.struct(F.col(time).alias("t"), F.col(value).alias("v"))
        aggs += [
            F.min(time).alias("First_Datetime"),
            F.min_by(value, tv).alias("First_Value"),
            F.max(time).alias("Last_Datetime"),
            F.max_by(value, tv).alias("Last_Value"),
        ]
    return vitals.groupBy(*keys).agg(*aggs)


def measurement_first_last_ties(
    vitals: DataFrame,
    keys: Sequence[str] = ("visit_occurrence_id", "measurement_source_value"),
    value: str = "value_as_number",
    time: str = "measurement_datetime",
) -> DataFrame:
    """J7 ``ties='all'``: every value recorded at the first and at the last time.

    The reference fans ties out into first-tie x last-tie rows; here each tied
    row is returned once, in long form ``(keys, position, Datetime, Value)``
    with ``position`` 'first' or 'last', so a group with many ties grows the
    output linearly and no pairs of rows are formed. The per-group bounds
    come from one partially aggregated ``groupBy``; keys match null-safely
    (D7: a null key is one group).
    """
    keys = list(keys)
    bounds = vitals.groupBy(*keys).agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
    v, b = vitals.select(*keys, time, value).alias("v"), bounds.alias("b")
    cond = [F.col(f"v.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    cond.append((F.col(f"v.{time}") == F.col("b._first")) | (F.col(f"v.{time}") == F.col("b._last")))
    joined = v.join(b, cond, "inner")
    pos = F.explode(F.array_compact(F.array(
        F.when(F.col(f"v.{time}") == F.col("b._first"), F.lit("first")),
        F.when(F.col(f"v.{time}") == F.col("b._last"), F.lit("last")),
    )))
    return joined.select(*[F.col(f"v.{k}").alias(k) for k in keys], pos.alias("position"),
                         F.col(f"v.{time}").alias("Datetime"), F.col(f"v.{value}").alias("Value"))


def measurement_pull(
    measurement: DataFrame,
    concept: DataFrame | None = None,
    codes: Sequence[int] | None = VITAL_CODES,
    concept_filter=None,
    keys: Sequence[str] = ("visit_occurrence_id", "measurement_source_value"),
    value: str = "value_as_number",
    time: str = "measurement_datetime",
    concept_key: str = "measurement_concept_id",
) -> DataFrame:
    """A3/A4: the full pull - selection, decode, one aggregation.

    Output: keys, Max_value, Min_value, Mean_value, First_Datetime,
    First_Value, Last_Datetime, Last_Value. Use ``comparison_sample`` for the
    second frame of the reference's (main, sample) pair.
    """
    sel = select_measurements(measurement, concept, codes, concept_key, concept_filter=concept_filter)
    sel = sel.select(*keys, value, time)
    return measurement_summary(sel, keys, value, time)
