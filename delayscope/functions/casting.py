"""Text to number conversions that yield NULL, never an error, on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLANKS = " \t\r\n\f\v"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clean_text(value: Column | str) -> Column:
    """Text without surrounding white space; NULL becomes the empty string."""
    return F.coalesce(F.trim(as_column(value).cast("string"), F.lit(_BLANKS)), F.lit(""))


def number(value: Column | str) -> Column:
    """Text as double; blank or unparsable text, and NaN, become NULL.

    The steps are functions over an array of one element, which names what they share. Spark
    keeps these out of the one method it generates per stage: written out for a dozen columns
    that method passes 8,000 bytes, from where on the JVM interprets it and never compiles it.
    """
    text = F.array(F.trim(as_column(value).cast("string"), F.lit(_BLANKS)))

    # The JVM parser accepts a trailing type letter ("10d") and hexadecimal floats
    # ("0x1p3"); those are not numbers here.
    def parsed(t: Column) -> Column:
        plain = ~F.substring(t, -1, 1).isin("d", "D", "f", "F") & (F.instr(F.lower(t), "x") == 0)
        return F.when(plain, t).try_cast("double")

    return F.get(F.filter(F.transform(text, parsed), lambda v: ~F.isnan(v)), F.lit(0))


def whole(value: Column | str) -> Column:
    """Text as a 64-bit integer, cutting a fraction off: '12.0' and '12.7' are both 12.

    NULL where there is no number, and where it is beyond 64 bits.
    """
    return number(value).try_cast("bigint")


def number_or_zero(value: Column | str) -> Column:
    return F.coalesce(number(value), F.lit(0.0))


def whole_or_zero(value: Column | str) -> Column:
    """0 where there is no number; NULL where there is one that 64 bits cannot hold."""
    return F.when(number(value).isNull(), F.lit(0).cast("bigint")).otherwise(whole(value))


def first_filled(*values: Column | str) -> Column:
    """The first value that is neither NULL nor blank."""
    return F.coalesce(*(F.nullif(clean_text(value), F.lit("")) for value in values))
