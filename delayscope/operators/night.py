"""How one carrier's flights spread over the day, and its night departures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayscope.functions import hour_of
from delayscope.operators.ranking import first_k

SHOWN = ["OP_UNIQUE_CARRIER", "CRS_DEP_TIME", "DEP_DELAY", "CANCELLED", "DIVERTED"]


def _of_carrier(flights: DataFrame, carrier: str) -> DataFrame:
    return flights.where(F.col("OP_UNIQUE_CARRIER") == carrier)


def hourly_status(flights: DataFrame, carrier: str = "WN") -> DataFrame:
    """Flights, cancelled, not cancelled and without departure delay, by scheduled hour."""
    return (
        _of_carrier(flights, carrier)
        .groupBy(hour_of("CRS_DEP_TIME").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("total_flights"),
            F.count_if(F.col("CANCELLED") == 1).alias("cancelled"),
            F.count_if(F.col("CANCELLED") == 0).alias("not_cancelled"),
            F.count_if(F.col("DEP_DELAY").isNull()).alias("dep_delay_null"),
        )
    )


def night_flights(flights: DataFrame, carrier: str = "WN", last_hour: int = 4, k: int = 100) -> DataFrame:
    """The first k night departures of each variant: all, flown, flown with a known delay.

    One scan serves the three variants; each task forwards at most k rows of each.
    """
    flown = F.col("CANCELLED") == 0
    variants = F.array_remove(
        F.array(
            F.lit("all"),
            F.when(flown, "not_cancelled").otherwise(""),
            F.when(flown & F.col("DEP_DELAY").isNotNull(), "with_delay").otherwise(""),
        ),
        "",
    )
    night = (
        _of_carrier(flights, carrier)
        .where(F.col("CRS_DEP_TIME").between(0, last_hour * 100 + 99))
        .select(*SHOWN, hour_of("CRS_DEP_TIME").alias("HOUR"), F.explode(variants).alias("variant"))
    )
    order = ["CRS_DEP_TIME", *(c for c in SHOWN if c != "CRS_DEP_TIME")]
    return first_k(night, ["variant"], order, k)


def clock_range(flights: DataFrame, carrier: str = "WN") -> DataFrame:
    """Earliest and latest scheduled departure."""
    return _of_carrier(flights, carrier).agg(
        F.min("CRS_DEP_TIME").alias("min_crs_dep_time"), F.max("CRS_DEP_TIME").alias("max_crs_dep_time")
    )
