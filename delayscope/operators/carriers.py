"""Arrival delay and its causes per carrier, and the ranking by mean delay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayscope.schema import CAUSES

MIN_FLIGHTS = 500
TOP_K = 10


def completed_flights(flights: DataFrame) -> DataFrame:
    """Flights neither cancelled nor diverted, with a known arrival delay."""
    return flights.where((F.col("CANCELLED") == 0) & (F.col("DIVERTED") == 0) & F.col("ARR_DELAY").isNotNull())


def carrier_stats(flights: DataFrame) -> DataFrame:
    """Flight count, mean arrival delay and mean minutes of each cause, per carrier."""
    return (
        completed_flights(flights)
        .groupBy(F.col("OP_UNIQUE_CARRIER").alias("carrier"))
        .agg(
            F.count(F.lit(1)).alias("num_flights"),
            F.round(F.avg("ARR_DELAY"), 4).alias("arrdelay_mean"),
            *(F.round(F.avg(cause), 4).alias(f"{cause.lower()}_mean") for cause in CAUSES),
        )
    )


def top_carriers(stats: DataFrame, k: int = TOP_K, min_flights: int = MIN_FLIGHTS) -> DataFrame:
    """The k carriers with the worst mean arrival delay among those flown often enough.

    Ties go to the carrier code. Plans as a per-task top-k, not a full sort.
    """
    return (
        stats.where(F.col("num_flights") >= min_flights)
        .orderBy(F.col("arrdelay_mean").desc(), "carrier")
        .limit(k)
    )
