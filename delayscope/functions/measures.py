"""Row-level expressions on delays and delay causes."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from delayscope.functions.casting import as_column
from delayscope.functions.rounding import binary_round

def cause_total(columns: Iterable[Column | str]) -> Column:
    """Sum across columns; NULL when any of them is NULL."""
    return reduce(add, map(as_column, columns))


def all_null(columns: Iterable[Column | str]) -> Column:
    return reduce(and_, (as_column(c).isNull() for c in columns))


def any_null(columns: Iterable[Column | str]) -> Column:
    return reduce(or_, (as_column(c).isNull() for c in columns))


def delay_band(delay: Column | str) -> Column:
    """On time or early, slightly late, officially late; NULL for an unknown delay."""
    value = as_column(delay)
    return F.when(value <= 0, "le_0").when(value < 15, "gt_0_lt_15").when(value >= 15, "ge_15")


def percent(part: Column | str, whole: Column | str) -> Column:
    """100 * part / whole; NULL when the whole is zero."""
    return F.try_divide(as_column(part), as_column(whole)) * F.lit(100.0)


def share_percent(part: Column | str, total: Column | str, digits: int = 4) -> Column:
    """Rounded percentage of a total; 0.0 when the total is not positive."""
    return F.when(as_column(total) > 0, binary_round(percent(part, total), digits)).otherwise(F.lit(0.0))


def close_to(left: Column, right: Column, relative: float = 0.0, absolute: float = 0.0) -> Column:
    """|left - right| <= max(relative * larger magnitude, absolute).

    An infinity is close to itself only, NaN to nothing.
    """
    bound = F.greatest(F.lit(relative) * F.greatest(F.abs(left), F.abs(right)), F.lit(absolute))
    apart = F.abs(left - right)
    near = (apart < F.lit(float("inf"))) & (apart <= bound)
    return ~F.isnan(left) & ~F.isnan(right) & ((left == right) | near)
