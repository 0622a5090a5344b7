"""Monthly delay and cancellation statistics per carrier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delayscope.functions import percent
from delayscope.schema import MONTHLY_COUNTS, MONTHLY_KEYS, MONTHLY_MEASURES

DEFAULT_CARRIERS = ("AA", "DL")

_MEASURED = {"dep": "DEP_DELAY", "arr": "ARR_DELAY"}


def _of_carriers(flights: DataFrame, carriers: Sequence[str] | None) -> DataFrame:
    chosen = flights if carriers is None else flights.where(F.col("OP_UNIQUE_CARRIER").isin(list(carriers)))
    return chosen.withColumnsRenamed({"MONTH": "month", "OP_UNIQUE_CARRIER": "airline"})


def monthly_stats(flights: DataFrame, carriers: Sequence[str] | None = DEFAULT_CARRIERS) -> DataFrame:
    """Counts, mean/min/max delays of flights that were not cancelled, cancellation rate.

    One conditional aggregation: one scan, one shuffle of partial rows. A group whose
    flights were all cancelled keeps its row, with NULL statistics.
    """
    cancelled, flown = F.col("CANCELLED") == 1, F.col("CANCELLED") == 0
    stats = [
        stat(F.when(flown, F.col(column))).alias(f"{side}_delay_{name}")
        for side, column in _MEASURED.items()
        for name, stat in (("mean", F.avg), ("min", F.min), ("max", F.max))
    ]
    grouped = (
        _of_carriers(flights, carriers)
        .groupBy(*MONTHLY_KEYS)
        .agg(
            F.count(F.lit(1)).alias("total_flights"),
            F.count_if(cancelled).alias("cancelled_flights"),
            F.count_if(flown).alias("non_cancelled_flights"),
            *stats,
        )
        .withColumn("cancellation_rate", percent("cancelled_flights", "total_flights"))
    )
    return grouped.select(
        *MONTHLY_KEYS, *MONTHLY_COUNTS, *(F.round(name, 4).alias(name) for name in MONTHLY_MEASURES)
    )


def monthly_stats_joined(flights: DataFrame, carriers: Sequence[str] | None = DEFAULT_CARRIERS) -> DataFrame:
    """The same measures from three aggregates joined on their keys.

    Kept as an independent formulation to check ``monthly_stats`` against; it reads the
    facts three times. Inner joins drop groups without a single measured delay.
    """
    chosen = _of_carriers(flights, carriers)
    flown = chosen.where(F.col("CANCELLED") == 0)
    sides = [
        flown.where(F.col(column).isNotNull())
        .groupBy(*MONTHLY_KEYS)
        .agg(
            *(
                F.round(stat(column), 4).alias(f"{side}_delay_{name}")
                for name, stat in (("mean", F.avg), ("min", F.min), ("max", F.max))
            )
        )
        for side, column in _MEASURED.items()
    ]
    rates = chosen.groupBy(*MONTHLY_KEYS).agg(
        F.round(percent(F.sum("CANCELLED"), F.count(F.lit(1))), 4).alias("cancellation_rate")
    )
    return sides[0].join(sides[1], MONTHLY_KEYS).join(rates, MONTHLY_KEYS).select(*MONTHLY_KEYS, *MONTHLY_MEASURES)
