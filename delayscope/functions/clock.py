"""HHMM clock times, and the timestamps that place months and hours on a time axis."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from delayscope.functions.casting import as_column


def hour_of(hhmm: Column | str) -> Column:
    """Hour of an HHMM integer. Floors, so negative input gives a negative hour."""
    return F.floor(as_column(hhmm) / F.lit(100)).cast("int")


def bad_minutes(hhmm: Column | str) -> Column:
    """True where the last two digits are not a minute; NULL for NULL."""
    return F.pmod(as_column(hhmm), F.lit(100)) >= F.lit(60)


def month_start(month: Column | str, year: int = 2025, valid: Iterable[int] = (1, 2, 3, 4)) -> Column:
    """First instant of the month; a month outside ``valid`` is an error."""
    value = as_column(month).cast("int")
    stamp = F.make_timestamp_ntz(F.lit(year), value, F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    problem = F.raise_error(F.concat(F.lit("month outside the series: "), value.cast("string")))
    return F.when(value.isin(list(valid)), stamp).otherwise(problem.cast("timestamp_ntz"))


def hour_start(hour: Column | str, day: str = "2025-01-01") -> Column:
    """The hour placed on a fixed day; an hour outside 0..23 is an error."""
    value = as_column(hour).cast("int")
    stamp = F.lit(day).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), value)
    problem = F.raise_error(F.concat(F.lit("hour outside 0..23: "), value.cast("string")))
    return F.when(value.between(0, 23), stamp).otherwise(problem.cast("timestamp_ntz"))
