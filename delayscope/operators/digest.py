"""Mergeable t-digests as centroid tables, in built-in functions.

A digest summarises the values of a group by centroids: rows of (total, weight, low, high)
that cover neighbouring values. How many values one centroid may cover follows from the
scale function

    k(q) = compression * (asin(2 q - 1) / pi + 1/2)

of the cumulative share q: a centroid covers one unit of k, so that it is widest in the
middle and narrow at both ends. A group has at most compression + 1 centroids. Centroids of
several digests are merged by putting them in order and cutting anew, so digests of parts
roll up to any coarser group without the values.

One unit of k around q is pi * sqrt(q (1 - q)) / compression of the ranks; every merge may
add one. ``rank_tolerance`` states the resulting bound.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delayscope.operators.percentiles import percentile_name

COMPRESSION = 100
#: Digests of single tasks are merged in so many shares first.
MERGE_WIDTH = 64
CENTROID = ["total", "weight", "low", "high"]


def _unit(middle: Column, whole: Column, compression: int) -> Column:
    """The unit of the scale function that a centroid with its middle at this rank is in."""
    q = F.least(F.greatest(middle / whole, F.lit(0.0)), F.lit(1.0))
    return F.floor((F.asin(q * 2 - 1) / F.pi() + 0.5) * compression)


def merge_digests(centroids: DataFrame, keys: Sequence[str], compression: int = COMPRESSION) -> DataFrame:
    """The digests of all centroids with the same keys: put in order, cut anew, added up."""
    group = Window.partitionBy(*keys)
    order = group.orderBy(F.col("total") / F.col("weight"), "low", "high", "weight").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = F.sum("weight").over(order) - F.col("weight") / 2
    placed = centroids.withColumn("_unit", _unit(middle, F.sum("weight").over(group), compression))
    return placed.groupBy(*keys, "_unit").agg(
        F.sum("total").alias("total"), F.sum("weight").alias("weight"), F.min("low").alias("low"), F.max("high").alias("high")
    ).select(*keys, *CENTROID)


def build_digests(rows: DataFrame, keys: Sequence[str], value: str, compression: int = COMPRESSION) -> DataFrame:
    """The digest of every group of ``keys``; NULL and NaN values are left out.

    Equal values are counted first, on the map side too. Every task's share of a group
    gets a digest of its own, these are merged in a bounded number of shares and then
    once more, so no task holds a group's values however large or uneven groups are.
    """
    number = F.col(value).cast("double")
    known = rows.where(F.col(value).isNotNull() & ~F.isnan(number))
    counted = known.groupBy(*keys, F.spark_partition_id().alias("_task"), number.alias("low")).agg(F.count(F.lit(1)).alias("weight"))
    singles = counted.select(*keys, "_task", (F.col("low") * F.col("weight")).alias("total"), "weight", "low", F.col("low").alias("high"))
    by_task = merge_digests(singles, [*keys, "_task"], compression)
    shares = merge_digests(by_task.withColumn("_share", F.col("_task") % MERGE_WIDTH), [*keys, "_share"], compression)
    return merge_digests(shares, keys, compression)


def digest_by(rows: DataFrame, keys: Sequence[str], part: str, value: str, compression: int = COMPRESSION) -> DataFrame:
    """One digest per group and part (a month, a file), to be stored and rolled up later.

    Unlike the shares of tasks, parts are the same in every run, and so is the result.
    """
    number = F.col(value).cast("double")
    known = rows.where(F.col(value).isNotNull() & ~F.isnan(number))
    counted = known.groupBy(*keys, part, number.alias("low")).agg(F.count(F.lit(1)).alias("weight"))
    singles = counted.select(*keys, part, (F.col("low") * F.col("weight")).alias("total"), "weight", "low", F.col("low").alias("high"))
    return merge_digests(singles, [*keys, part], compression)


def read_digests(centroids: DataFrame, keys: Sequence[str], probabilities: Sequence[float], digits: int | None = 4) -> DataFrame:
    """Exact count and approximate percentiles of every digest.

    A centroid stands at the middle of the ranks it covers; between two centroids the value
    is interpolated, before the first and after the last up to the smallest and largest value.
    """
    group = Window.partitionBy(*keys)
    order = group.orderBy(F.col("total") / F.col("weight"), "low", "high", "weight")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = centroids.withColumns({
        "_mean": F.col("total") / F.col("weight"), "_at": F.sum("weight").over(upto) - F.col("weight") / 2, "_all": F.sum("weight").over(group),
        "_least": F.min("low").over(group), "_most": F.max("high").over(group),
    })
    before_at, before_mean = F.lag("_at").over(order), F.lag("_mean").over(order)
    steps = placed.withColumns({
        "_from": F.coalesce(before_at, F.lit(0.0)), "_from_mean": F.coalesce(before_mean, F.col("_least")),
        "_last": F.lead("_at").over(order).isNull(),
    })

    def found(p: float) -> Column:
        rank = F.col("_all") * F.lit(float(p))
        inside = F.col("_from_mean") + (F.col("_mean") - F.col("_from_mean")) * ((rank - F.col("_from")) / (F.col("_at") - F.col("_from")))
        beyond = F.col("_mean") + (F.col("_most") - F.col("_mean")) * ((rank - F.col("_at")) / (F.col("_all") - F.col("_at")))
        here = F.when((rank >= F.col("_from")) & (rank < F.col("_at")), inside).when(F.col("_last") & (rank >= F.col("_at")), beyond)
        return F.min(here) if digits is None else F.round(F.min(here), digits)

    return steps.groupBy(*keys).agg(
        F.max("_all").cast("long").alias("n"), *(found(p).alias(percentile_name(p)) for p in probabilities)
    )


def rank_tolerance(p: float, levels: int, compression: int = COMPRESSION) -> float:
    """How far the rank of an estimate of p may be off, as a share, after so many levels of merging."""
    q = min(max(p, 1 / compression), 1 - 1 / compression)
    return levels * math.pi * math.sqrt(q * (1 - q)) / compression


def digest_rank_check(rows: DataFrame, estimates: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float],
                      levels: int, compression: int = COMPRESSION) -> DataFrame:
    """Is every estimate within the stated bound of its rank? One boolean per percentile.

    An estimate v of p is right when p lies between the shares below v and up to v, give or
    take the tolerance and one value of the group.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_f"))
    names = [percentile_name(p) for p in probabilities]
    named = estimates.select(*(F.col(k).alias(f"_of_{k}") for k in keys), "n", *names)
    joined = counted.join(named, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    checks = []
    for p, name in zip(probabilities, names):
        below = F.sum(F.when(F.col("_v") < F.col(name), F.col("_f")).otherwise(0))
        upto = F.sum(F.when(F.col("_v") <= F.col(name), F.col("_f")).otherwise(0))
        slack = F.sum("_f") * rank_tolerance(p, levels, compression) + 1
        rank = F.sum("_f") * p
        checks.append(((below <= rank + slack) & (upto >= rank - slack)).alias(f"{name}_ok"))
    return joined.groupBy(*keys, "n").agg(*checks)
