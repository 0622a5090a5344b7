"""Tolerant comparison of two result tables.

Both sides are stacked and grouped by key instead of joined: one shuffle finds keys of
one side only, repeated keys and differing values, and repeated keys never pair up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delayscope import schema as s
from delayscope.functions import clean_text, close_to, number
from delayscope.sources.contract import require_columns

TOLERANCE = 1e-4

# Key and value columns of each result that exists in two formulations.
RESULTS = {
    "monthly": (s.MONTHLY_KEYS, s.MONTHLY_MEASURES),
    "carriers": (s.CARRIER_KEYS, s.CARRIER_MEASURES),
    "top_carriers": (s.CARRIER_KEYS, s.CARRIER_MEASURES),
    "hourly_percentiles": (s.HOURLY_KEYS, s.HOURLY_MEASURES),
    "extremes": (s.EXTREME_KEYS, s.EXTREME_MEASURES),
}


def same_value(left: Column, right: Column, tolerance: float = TOLERANCE) -> Column:
    """Numbers within the tolerance (relative or absolute), otherwise equal trimmed texts.

    NULL and blank text are the same value.
    """
    a, b = number(left), number(right)
    numeric = a.isNotNull() & b.isNotNull()
    return F.when(numeric, close_to(a, b, tolerance, tolerance)).otherwise(clean_text(left) == clean_text(right))


def _grouped(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    require_columns(left, [*keys, *values], "left")
    require_columns(right, [*keys, *values], "right")

    def side(df: DataFrame, name: str) -> DataFrame:
        texts = F.struct(*(F.col(v).cast("string").alias(v) for v in values)) if values else F.lit(True)
        return df.select(*(clean_text(k).alias(k) for k in keys), F.lit(name).alias("_side"), texts.alias("_row"))

    def picked(name: str) -> Column:
        return F.when(F.col("_side") == name, F.col("_row"))

    return (
        side(left, "l")
        .unionByName(side(right, "r"))
        .groupBy(*keys)
        .agg(
            F.count_if(F.col("_side") == "l").alias("_in_left"),
            F.count_if(F.col("_side") == "r").alias("_in_right"),
            F.max(picked("l")).alias("_left"),
            F.max(picked("r")).alias("_right"),
        )
    )


def diff_results(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str],
                 tolerance: float = TOLERANCE) -> DataFrame:
    """Every difference: (keys..., column, left_value, right_value, kind).

    ``kind`` is only_left, only_right, duplicate_left, duplicate_right (the value columns
    then hold how often the key occurs) or value. No rows means the tables agree.
    """
    one_each = (F.col("_in_left") == 1) & (F.col("_in_right") == 1)
    nothing = F.lit(None).cast("string")
    texts = [F.col("_in_left").cast("string"), F.col("_in_right").cast("string")]

    def finding(when: Column, kind: str, column: Column, a: Column, b: Column) -> Column:
        return F.when(
            when,
            F.struct(column.alias("column"), a.alias("left_value"), b.alias("right_value"), F.lit(kind).alias("kind")),
        )

    found = [
        finding(F.col("_in_right") == 0, "only_left", nothing, nothing, nothing),
        finding(F.col("_in_left") == 0, "only_right", nothing, nothing, nothing),
        finding(F.col("_in_left") > 1, "duplicate_left", nothing, *texts),
        finding(F.col("_in_right") > 1, "duplicate_right", nothing, *texts),
    ]
    for name in values:
        a, b = F.col("_left")[name], F.col("_right")[name]
        found.append(finding(one_each & ~same_value(a, b, tolerance), "value", F.lit(name), a, b))
    return _grouped(left, right, keys, values).select(
        *keys, F.inline(F.filter(F.array(*found), lambda f: f.isNotNull()))
    )


def diff_order(left: DataFrame, right: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """Positions at which two ranked tables hold different keys.

    ``position`` is the stored rank of a row, so no row order has to be assumed.
    """
    def ranked(df: DataFrame) -> DataFrame:
        return df.select(position, F.concat_ws("|", *(clean_text(k) for k in keys)).alias("key"))

    differing = diff_results(ranked(left), ranked(right), [position], ["key"])
    return differing.withColumn("kind", F.lit("order"))


def key_sets(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key with where it occurs: only_left, only_right or both."""
    where = (
        F.when(F.col("_in_right") == 0, "only_left").when(F.col("_in_left") == 0, "only_right").otherwise("both")
    )
    return _grouped(left, right, keys, []).select(*keys, where.alias("membership"))


def results_agree(diff: DataFrame) -> bool:
    return diff.isEmpty()
