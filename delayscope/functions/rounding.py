"""Rounding and number texts for timing tables.

Spark's ``round`` works on the shortest decimal text of a double and rounds halves
up. Timing tables need the other convention: the exact binary value decides, and
true halves go to the even digit (what C ``printf`` and Python ``round`` do).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from delayscope.functions.casting import as_column

_SPLIT = 134217729.0  # 2**27 + 1: splits a double into two exact halves
_MISSING = "—"


def binary_round(value: Column | str, digits: int) -> Column:
    """Correctly rounded to ``digits`` decimals, halves to even, on the exact binary value."""
    x = as_column(value).cast("double")
    scale = F.lit(float(10**digits))
    scaled = x * scale
    wide = x * F.lit(_SPLIT)
    high = wide - (wide - x)
    # What the multiplication lost; it breaks ties that only look exact.
    lost = (high * scale - scaled) + (x - high) * scale
    below = F.floor(scaled).cast("double")
    rest = scaled - below
    tie = rest == F.lit(0.5)
    up = (rest > 0.5) | (tie & (lost > 0)) | (tie & (lost == 0) & (F.pmod(below, F.lit(2.0)) == 1))
    rounded = F.when(up, below + 1).otherwise(below) / scale
    # Scaled doubles this large are whole already (and would overflow the floor).
    return F.when(F.abs(scaled) < F.lit(2.0**52), rounded).otherwise(x)


def number_text(value: Column | str, digits: int = 2) -> Column:
    """Fixed-point text, or a dash for NULL."""
    shown = F.format_string(f"%.{digits}f", binary_round(value, digits))
    return F.when(as_column(value).isNull(), F.lit(_MISSING)).otherwise(shown)


def mean_std_text(mean: Column | str, std: Column | str) -> Column:
    """'mean ± std', only the mean when the deviation is unknown, a dash when the mean is."""
    both = F.concat(number_text(mean), F.lit(" ± "), number_text(std))
    return F.when(as_column(mean).isNull() | as_column(std).isNull(), number_text(mean)).otherwise(both)


def thousands(value: Column | str, digits: int = 0) -> Column:
    """Grouped with dots and a decimal comma: 1234567.5 with two digits is '1.234.567,50'."""
    x = as_column(value)
    shown = F.format_number(binary_round(x, digits) if digits else x, digits)
    return F.translate(shown, ",.", ".,")
