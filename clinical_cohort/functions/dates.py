"""Date and time scalars (M1-M7). All are built-in Column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DAYS_PER_YEAR = 365.25


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def visit_length(start: str | Column, end: str | Column) -> Column:
    """M1: length of stay in whole seconds (end - start); null if either is null."""
    return F.timestamp_diff("SECOND", _c(start), _c(end))


def age_at(when: str | Column, birth: str | Column) -> Column:
    """M2: floor(days between birth and ``when`` / 365.25) as BIGINT."""
    return F.floor(F.datediff(_c(when), _c(birth)) / F.lit(DAYS_PER_YEAR)).cast("bigint")


def _date_lit(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (dt.date, dt.datetime)):
        return F.lit(as_of)
    return F.to_date(F.lit(str(as_of)))


def age_current(birth: str | Column, death: str | Column, as_of="2024-01-01") -> Column:
    """M3: age at death, or at ``as_of`` for the living (no wall clock, D15)."""
    return F.when(_c(death).isNull(), age_at(_date_lit(as_of), birth)).otherwise(age_at(death, birth))


def age_fractional(when: str | Column, birth: str | Column) -> Column:
    """M4: fractional age in years (days / 365.25)."""
    return F.datediff(_c(when), _c(birth)) / F.lit(DAYS_PER_YEAR)


def birth_year(birth: str | Column) -> Column:
    """M5: calendar year of birth."""
    return F.year(_c(birth))


def age_by_year(end: str | Column, birth: str | Column) -> Column:
    """M6: year(visit end) - birth year; null when either is missing."""
    return F.year(_c(end)) - F.year(_c(birth))


def to_date_safe(text: str | Column, fmt: str | None = None) -> Column:
    """M7: text to date; unparsable text gives null instead of an ANSI error."""
    c = _c(text)
    return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)
