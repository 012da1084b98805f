"""Row selections and column hygiene.

All functions are lazy DataFrame -> DataFrame transformations built from
Column expressions, so Catalyst can push them into the parquet scan
(``PushedFilters``) or below joins.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def _as_list(values) -> list:
    # A bare string is one literal, not a sequence of characters.
    if isinstance(values, (str, bytes)) or not isinstance(values, Sequence):
        return [values]
    return list(values)


def numeric_condition(column: str | Column, values: Sequence) -> Column:
    """F1 rule: two values -> closed range, otherwise equality with the first."""
    c = F.col(column) if isinstance(column, str) else column
    values = _as_list(values)
    if len(values) == 2:
        return c.between(values[0], values[1])
    return c == F.lit(values[0])


def filter_numeric(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """closed range for two values, equality otherwise; nulls drop out."""
    if not _as_list(values):
        return df
    return df.where(numeric_condition(column, values))


def filter_in(df: DataFrame, column: str, values) -> DataFrame:
    """keep rows whose column is in ``values``."""
    values = _as_list(values)
    if not values:
        return df
    return df.where(F.col(column).isin(values))


def filter_not_in(df: DataFrame, column: str, values, keep_null: bool = False) -> DataFrame:
    """exclusion; nulls are kept only when ``keep_null``."""
    values = _as_list(values)
    cond = ~F.col(column).isin(values) if values else F.lit(True)
    if keep_null:
        cond = cond | F.col(column).isNull()
    else:
        cond = cond & F.col(column).isNotNull()
    return df.where(cond)


def filter_datetime(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """closed range on a timestamp for two values, equality otherwise."""
    return filter_numeric(df, column, values)


def filter_by_map(df: DataFrame, mapping: Mapping[str, object]) -> DataFrame:
    """conjunction of ``filter_in`` over a ``{column: values}`` dict."""
    return reduce(lambda acc, kv: filter_in(acc, kv[0], kv[1]), mapping.items(), df)


@dataclass
class CohortFilter:
    """the cohort selection criteria; an empty list means no filter."""

    age: Sequence[int] = field(default_factory=list)
    gender: Sequence[str] = field(default_factory=list)
    race: Sequence[str] = field(default_factory=list)
    ethnicity: Sequence[str] = field(default_factory=list)
    insurance: Sequence[str] = field(default_factory=list)
    visit_date: Sequence = field(default_factory=list)
    visit_location: Mapping[str, object] = field(default_factory=dict)
    care_site: Mapping[str, object] = field(default_factory=dict)
    columns: Mapping[str, str] = field(default_factory=lambda: {
        "age": "age",
        "gender": "gender_source_value",
        "race": "race_source_value",
        "ethnicity": "ethnicity_source_value",
        "insurance": "plan_source_value",
        "visit_date": "visit_start_datetime",
    })

    def is_empty(self) -> bool:
        return not any([self.age, self.gender, self.race, self.ethnicity, self.insurance,
                        self.visit_date, self.visit_location, self.care_site])


def apply_cohort_filters(df: DataFrame, flt: CohortFilter | None) -> DataFrame:
    """conjunctive cohort filter (fold of F1, F2, F4, F5)."""
    if flt is None:
        return df
    cols = flt.columns
    df = filter_numeric(df, cols["age"], flt.age) if flt.age else df
    for name in ("gender", "race", "ethnicity", "insurance"):
        values = getattr(flt, name)
        if values:
            df = filter_in(df, cols[name], values)
    df = filter_datetime(df, cols["visit_date"], flt.visit_date) if flt.visit_date else df
    df = filter_by_map(df, flt.visit_location)
    return filter_by_map(df, flt.care_site)


def contains_any(column: str | Column, needles: Sequence[str]) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return reduce(lambda a, b: a | b, [c.contains(n) for n in _as_list(needles)])


def filter_contains(df: DataFrame, column: str, needles: Sequence[str]) -> DataFrame:
    """F8: substring search with OR across needles (case-sensitive)."""
    return df.where(contains_any(column, needles))


def flag_is(column: str | Column, value: bool) -> Column:
    """Text- or boolean-typed flag compared with True/False."""
    c = F.col(column) if isinstance(column, str) else column
    return F.lower(c.cast("string")) == F.lit("true" if value else "false")


def filter_flag(df: DataFrame, column: str, value: bool = True) -> DataFrame:
    """positive/negative filter on a 'True'/'False' text or boolean column."""
    return df.where(flag_is(column, value))


def restrict_to(df: DataFrame, ids: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """keep rows whose key appears in ``ids`` (left-semi join).

    Replaces ``isin(<python list>)``: the id list stays a DataFrame, Spark
    broadcasts it when its measured size allows and shuffles otherwise.
    """
    keys = _as_list(key)
    return df.join(ids.select(*keys), on=keys, how="left_semi")


def filter_since_start(df: DataFrame, event_ts: str, start_ts: str, max_seconds: int) -> DataFrame:
    """events within ``max_seconds`` after the visit start (inclusive)."""
    gap = F.timestamp_diff("SECOND", F.col(start_ts), F.col(event_ts))
    return df.where(gap.between(0, max_seconds))


_STRIP = re.compile(r"[ ,;{}()\n\t=]+")


def clean_name(name: str, prefix: str = "") -> str:
    """F15 rule for one name: '.' -> '_', strip ' ,;{}()\\n\\t=', add prefix."""
    return prefix + _STRIP.sub("", name.replace(".", "_"))


def clean_columns(df: DataFrame, prefix: str = "", keep: Sequence[str] = ()) -> DataFrame:
    """rename every column but ``keep``; a collision raises."""
    keep = set(keep)
    names = [c if c in keep else clean_name(c, prefix) for c in df.columns]
    seen: dict[str, str] = {}
    for old, new in zip(df.columns, names):
        if new in seen:
            raise ValueError(f"column names {seen[new]!r} and {old!r} both clean to {new!r}")
        seen[new] = old
    return df.toDF(*names)


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """missing numbers -> 0 (non-numeric columns are left alone)."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    return df.fillna(0, subset=list(columns)) if columns else df


def distinct_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """duplicate removal over all columns or the given key columns."""
    return df.dropDuplicates(list(keys)) if keys else df.distinct()
