"""Departure-delay percentiles per carrier and hour: counted, approximate, sketched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayscope.functions import hour_of
from delayscope.operators import percentiles as pct
from delayscope.schema import HOURLY_KEYS

DEFAULT_CARRIERS = ("AA", "DL", "UA", "WN")
PROBABILITIES = (0.25, 0.50, 0.75, 0.90)
ACCURACY = 1000
SKETCH_SIZE = 200
_MERGE_WIDTH = 64


def hourly_departures(flights: DataFrame, carriers: Sequence[str] | None = DEFAULT_CARRIERS,
                      keep: Sequence[str] = ()) -> DataFrame:
    """(airline, hour, kept columns, DEP_DELAY) of flights that left, at clock hours 0 to 23.

    The range test on the raw clock time selects the same rows as 0 <= hour <= 23 and,
    unlike a test on the derived hour, is pushed into the Parquet scan.
    """
    chosen = flights if carriers is None else flights.where(F.col("OP_UNIQUE_CARRIER").isin(list(carriers)))
    return chosen.where(
        (F.col("CANCELLED") == 0) & F.col("DEP_DELAY").isNotNull() & F.col("CRS_DEP_TIME").between(0, 2399)
    ).select(
        F.col("OP_UNIQUE_CARRIER").alias("airline"), hour_of("CRS_DEP_TIME").alias("hour"), *keep, "DEP_DELAY"
    )


def delay_counts(departures: DataFrame) -> DataFrame:
    """Flights per (airline, hour, delay in minutes).

    A few thousand rows per airline and hour however many flights there are. The exact
    percentiles and the extremes all follow from it, so one pass over the facts and one
    small stored table serve them all.
    """
    return pct.count_values(departures, HOURLY_KEYS, "DEP_DELAY")


def percentiles_from_counts(counts: DataFrame, probabilities: Sequence[float] = PROBABILITIES,
                            interpolate: bool = False) -> DataFrame:
    """Exact percentiles: an occurring delay, or linear interpolation between two."""
    form = pct.interpolated if interpolate else pct.observed
    found = form(counts, HOURLY_KEYS, "DEP_DELAY", probabilities, pct.total_frequency().alias("num_flights"))
    names = [pct.percentile_name(p) for p in probabilities]
    return found.select(*HOURLY_KEYS, "num_flights", *(F.round(n, 4).alias(n) for n in names))


def hourly_percentiles(flights: DataFrame, carriers: Sequence[str] | None = DEFAULT_CARRIERS,
                       probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """Percentiles that are occurring delays, with exact rank."""
    return percentiles_from_counts(delay_counts(hourly_departures(flights, carriers)), probabilities)


def hourly_percentiles_interpolated(flights: DataFrame, carriers: Sequence[str] | None = DEFAULT_CARRIERS,
                                    probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """Percentiles interpolated linearly between neighbouring delays."""
    return percentiles_from_counts(delay_counts(hourly_departures(flights, carriers)), probabilities, True)


def hourly_percentiles_approx(flights: DataFrame, carriers: Sequence[str] | None = DEFAULT_CARRIERS,
                              probabilities: Sequence[float] = PROBABILITIES,
                              accuracy: int = ACCURACY) -> DataFrame:
    """Percentiles with rank error up to 1/accuracy, for delays too finely grained to count.

    All probabilities are read off a single sketch per group. Spark's sketch may be a whole
    rank beyond what it is asked for, too much in a group of fewer than ``accuracy`` flights; it
    is asked for half the error, where it is exact in these and within the bound in larger ones.
    """
    grouped = hourly_departures(flights, carriers).groupBy(*HOURLY_KEYS).agg(
        F.count(F.lit(1)).alias("num_flights"),
        F.percentile_approx("DEP_DELAY", [float(p) for p in probabilities], 2 * accuracy).alias("_found"),
    )
    return grouped.select(
        *HOURLY_KEYS,
        "num_flights",
        *(F.col("_found")[i].alias(pct.percentile_name(p)) for i, p in enumerate(probabilities)),
    )


def delay_sketches(flights: DataFrame, carriers: Sequence[str] | None = DEFAULT_CARRIERS,
                   by: Sequence[str] = (), size: int = SKETCH_SIZE) -> DataFrame:
    """Storable quantile sketches per (airline, hour) and any further grouping column.

    Every task sketches its own rows. Merging happens in two steps, first among a share
    of the tasks and then among the shares, so a hot group is not merged by one task.
    """
    share = (F.spark_partition_id() % _MERGE_WIDTH).alias("_share")
    rows = hourly_departures(flights, carriers, by).select("*", share)
    keys = [*HOURLY_KEYS, *by]
    return (
        rows.groupBy(*keys, "_share")
        .agg(F.kll_sketch_agg_double("DEP_DELAY", size).alias("_part"))
        .groupBy(*keys)
        .agg(F.kll_merge_agg_double("_part").alias("sketch"))
    )


def merge_sketches(sketches: DataFrame, keys: Sequence[str] = HOURLY_KEYS) -> DataFrame:
    """Roll stored sketches up to coarser keys without reading any flight again."""
    return sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def read_sketches(sketches: DataFrame, probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """Flight count (exact) and percentiles (approximate) held by each sketch."""
    keys = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(
        *keys,
        F.kll_sketch_get_n_double("sketch").alias("num_flights"),
        *(
            F.round(F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))), 4).alias(pct.percentile_name(p))
            for p in probabilities
        ),
    )


def sketch_rank_check(flights: DataFrame, estimates: DataFrame, tolerance: float = 0.02,
                      carriers: Sequence[str] | None = DEFAULT_CARRIERS,
                      probabilities: Sequence[float] = PROBABILITIES) -> DataFrame:
    """Is every estimate within ``tolerance`` of its rank? One boolean per percentile.

    An estimate v of p is right when p lies between the shares below v and up to v.
    """
    names = [pct.percentile_name(p) for p in probabilities]
    joined = delay_counts(hourly_departures(flights, carriers)).join(estimates, HOURLY_KEYS)
    weight = F.col(pct.FREQUENCY)
    checks = []
    for p, name in zip(probabilities, names):
        below = F.sum(F.when(F.col("DEP_DELAY") < F.col(name), weight).otherwise(0)) / F.sum(weight)
        upto = F.sum(F.when(F.col("DEP_DELAY") <= F.col(name), weight).otherwise(0)) / F.sum(weight)
        checks.append(((below <= p + tolerance) & (upto >= p - tolerance)).alias(f"{name}_ok"))
    return joined.groupBy(*HOURLY_KEYS, "num_flights").agg(*checks)


def delay_extremes(flights: DataFrame, carriers: Sequence[str] | None = DEFAULT_CARRIERS) -> DataFrame:
    """Smallest and largest departure delay per airline, over the same flights."""
    return _extremes(hourly_departures(flights, carriers))


def extremes_from_counts(counts: DataFrame) -> DataFrame:
    return _extremes(counts)


def _extremes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("airline").agg(
        F.round(F.min("DEP_DELAY"), 4).alias("min_delay"), F.round(F.max("DEP_DELAY"), 4).alias("max_delay")
    )
