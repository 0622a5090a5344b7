"""Percentiles per group that stay exact and spread over the cluster.

A percentile needs every value of its group. Sending a hot group's rows to one task
does not scale, so values are first counted: (keys, value) -> count combines on the map
side, shuffles on keys *and* value, and leaves one row per distinct value. For
whole-minute delays and millisecond timings that is a few thousand rows per group
whatever the number of flights, and percentiles of the counted values are exact.

For measures without such a resolution ``interpolated_by_rank`` selects by rank between
bounds that a sketch gives; approximate forms are in ``delayscope.operators.hourly`` and
``delayscope.operators.digest``.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FREQUENCY = "_frequency"


def percentile_name(p: float) -> str:
    """0.25 -> 'p25', 0.999 -> 'p99_9'."""
    return "p" + f"{p * 100:.6f}".rstrip("0").rstrip(".").replace(".", "_")


def count_values(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per key and distinct value, with how often it occurs."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(FREQUENCY))


def total_frequency() -> Column:
    return F.sum(FREQUENCY)


def interpolated(counted: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float],
                 *extra: Column) -> DataFrame:
    """Percentiles by linear interpolation between neighbours, from counted values."""
    found = F.percentile(value, [float(p) for p in probabilities], F.col(FREQUENCY))
    grouped = counted.groupBy(*keys).agg(found.alias("_found"), *extra)
    names = [percentile_name(p) for p in probabilities]
    kept = [c for c in grouped.columns if c != "_found"]
    return grouped.select(*kept, *(F.col("_found")[i].alias(name) for i, name in enumerate(names)))


def observed(counted: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float],
             *extra: Column) -> DataFrame:
    """The smallest occurring value with at least p of the group at or below it."""
    group = Window.partitionBy(*keys)
    upto = group.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumns({"_upto": F.sum(FREQUENCY).over(upto), "_all": F.sum(FREQUENCY).over(group)})

    def first_reaching(p: float) -> Column:
        # Whole-number form of rank >= ceil(p * n): no error from the product.
        part = Fraction(str(p))
        reached = F.col("_upto") * part.denominator >= F.col("_all") * part.numerator
        return F.min(F.when(reached, F.col(value)))

    return ranked.groupBy(*keys).agg(
        *extra, *(first_reaching(p).alias(percentile_name(p)) for p in probabilities)
    )


#: Error, as one part in so many of the ranks, of the sketch that brackets a percentile.
BRACKET_ACCURACY = 10_000


def interpolated_by_rank(rows: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float],
                         accuracy: int = BRACKET_ACCURACY) -> DataFrame:
    """Percentiles by linear interpolation for values that do not repeat, such as raw doubles.

    Selection by rank in two passes. A sketch per group, whose rank error is bounded, gives
    for each percentile two values that hold the wanted ranks between them. The second pass
    counts how many values lie below the lower one and puts in order only the values in
    between, about six parts in ``accuracy`` of a group of more rows than that. Neither collects a group: the
    sketches and the counts combine on the map side. Returns keys, ``n`` and the percentiles;
    NULL values are left out.
    """
    known = rows.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    margin = 3 / accuracy
    edges = [(max(0.0, float(p) - margin), min(1.0, float(p) + margin)) for p in probabilities]
    sketched = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"),
        F.percentile_approx("_v", [e for pair in edges for e in pair], accuracy).alias("_edges"),
    )
    ends = {}
    for i, (low, high) in enumerate(edges):
        # A few ranks matter in a small group, which is a bracket as a whole.
        small = F.col("n") <= accuracy
        ends[f"_low_{i}"] = F.col("_least") if low == 0 else F.when(small, F.col("_least")).otherwise(F.col("_edges")[2 * i])
        ends[f"_high_{i}"] = F.col("_most") if high == 1 else F.when(small, F.col("_most")).otherwise(F.col("_edges")[2 * i + 1])
    renamed = sketched.select(*(F.col(k).alias(f"_of_{k}") for k in keys), "n", *(c.alias(name) for name, c in ends.items()))
    met = known.join(renamed, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    inside = [F.col("_v").between(F.col(f"_low_{i}"), F.col(f"_high_{i}")) for i in range(len(edges))]
    any_inside = inside[0]
    for more in inside[1:]:
        any_inside = any_inside | more
    # Values outside all brackets only count; they collapse to one row per group and pattern.
    below = [(F.col("_v") < F.col(f"_low_{i}")).cast("int") for i in range(len(edges))]
    spots = [c.alias(f"_below_{i}") for i, c in enumerate(below)]
    counted = met.groupBy(*keys, "n", *ends, F.when(any_inside, F.col("_v")).alias("_v"), *spots).agg(F.count(F.lit(1)).alias(FREQUENCY))
    group = Window.partitionBy(*keys)
    upto = group.orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    columns = {}
    for i in range(len(edges)):
        within = F.col("_v").isNotNull() & F.col("_v").between(F.col(f"_low_{i}"), F.col(f"_high_{i}"))
        under = F.sum(F.col(f"_below_{i}") * F.col(FREQUENCY)).over(group)
        columns[f"_upto_{i}"] = F.when(within, under + F.sum(F.when(within, F.col(FREQUENCY)).otherwise(0)).over(upto))
    ranked = counted.withColumns(columns)

    def selected(i: int, rank: Column) -> Column:
        return F.min(F.when(F.col(f"_upto_{i}") > rank, F.col("_v")))

    picked = []
    for i, p in enumerate(probabilities):
        place = (F.col("n") - 1) * F.lit(float(p))
        picked += [selected(i, F.floor(place)).alias(f"_a_{i}"), selected(i, F.ceil(place)).alias(f"_b_{i}")]
    found = ranked.groupBy(*keys, "n").agg(*picked)

    def value_at(i: int, p: float) -> Column:
        place = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.floor(place), F.ceil(place)
        missing = F.raise_error(F.lit("a percentile lies outside its bracket")).cast("double")
        between = (high - place) * F.col(f"_a_{i}") + (place - low) * F.col(f"_b_{i}")
        return F.when(F.col(f"_a_{i}").isNull() | F.col(f"_b_{i}").isNull(), missing).when(low == high, F.col(f"_a_{i}")).otherwise(between)

    return found.select(*keys, "n", *(value_at(i, p).alias(percentile_name(p)) for i, p in enumerate(probabilities)))
