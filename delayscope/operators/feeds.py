"""Tidy tables for dashboards: keyed rows, per-metric values and time series.

A serving row is (key, field, value) or (key, columns...); a series point is
(key, metric, airline, ts, value). Inputs are finished result tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delayscope.functions import cause_total, hour_start, month_start, share_percent
from delayscope.schema import CAUSE_MEANS, EXTREME_MEASURES, HOURLY_MEASURES, MONTHLY_MEASURES


def _key(*parts: str | Column) -> Column:
    return F.concat_ws(":", *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _tall(df: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    values = df.select(*ids, *(F.col(m).cast("double").alias(m) for m in metrics))
    return values.unpivot(list(ids), list(metrics), "metric", "value")


# --- monthly statistics --------------------------------------------------------------


def monthly_rows(stats: DataFrame) -> DataFrame:
    """One keyed row per airline and month."""
    key = _key("q1", "row", F.col("airline"), F.col("month"))
    return stats.select(key.alias("key"), "month", "airline", *MONTHLY_MEASURES)


def monthly_values(stats: DataFrame) -> DataFrame:
    """One value per metric, airline and month."""
    return _tall(stats, ["airline", "month"], MONTHLY_MEASURES).select(
        _key("q1", "metric", F.col("metric"), F.col("airline")).alias("key"),
        F.col("month").cast("string").alias("field"),
        "value",
    )


def monthly_series(stats: DataFrame, year: int = 2025, months: Iterable[int] = (1, 2, 3, 4)) -> DataFrame:
    """The same values on a time axis; a month outside ``months`` is an error."""
    return _tall(stats, ["airline", "month"], MONTHLY_MEASURES).select(
        _key("q1", "ts", F.col("metric"), F.col("airline")).alias("key"),
        "metric",
        "airline",
        month_start("month", year, months).alias("ts"),
        "value",
    )


# --- carrier ranking -----------------------------------------------------------------


def ranked_carriers(top: DataFrame) -> DataFrame:
    """The ranking with ranks 1..k attached. ``top`` holds the k ranked rows only."""
    worst_first = Window.orderBy(F.col("arrdelay_mean").desc(), "carrier")
    return top.select(
        F.row_number().over(worst_first).alias("rank"), "carrier", "num_flights", "arrdelay_mean", *CAUSE_MEANS
    )


def ranked_rows(ranked: DataFrame) -> DataFrame:
    return ranked.select(_key("q2", "row", F.col("rank")).alias("key"), *ranked.columns)


def ranked_values(ranked: DataFrame) -> DataFrame:
    """One text value per rank: carrier, flights, mean delay, causes in minutes and percent."""
    zero = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in CAUSE_MEANS}
    total = cause_total(zero.values())
    values = {c: F.col(c) for c in ("carrier", "num_flights", "arrdelay_mean")}
    values |= {f"cause_abs:{c}": minutes for c, minutes in zero.items()}
    values |= {f"cause_pct:{c}": share_percent(minutes, total) for c, minutes in zero.items()}
    texts = ranked.select("rank", *(value.cast("string").alias(name) for name, value in values.items()))
    return texts.unpivot("rank", [F.col(f"`{name}`") for name in values], "metric", "value").select(
        _key("q2", "metric", F.col("metric")).alias("key"), F.col("rank").cast("string").alias("field"), "value"
    )


def cause_shares(ranked: DataFrame) -> DataFrame:
    """Minutes of each cause and its percentage of all cause minutes, per ranked carrier."""
    zeroed = ranked.select(
        "rank", "carrier", *(F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in CAUSE_MEANS)
    ).withColumn("_total", cause_total(CAUSE_MEANS))
    tall = zeroed.unpivot(["rank", "carrier", "_total"], CAUSE_MEANS, "cause", "minutes")
    return tall.select("rank", "carrier", "cause", "minutes", share_percent("minutes", "_total").alias("share_pct"))


# --- hourly percentiles and extremes -------------------------------------------------


def hourly_rows(percentiles: DataFrame) -> DataFrame:
    key = _key("q3", "row", "hourly", F.col("airline"), F.col("hour"))
    return percentiles.select(key.alias("key"), "airline", "hour", *HOURLY_MEASURES)


def hourly_values(percentiles: DataFrame) -> DataFrame:
    return _tall(percentiles, ["airline", "hour"], HOURLY_MEASURES).select(
        _key("q3", "metric", F.col("metric"), F.col("airline")).alias("key"),
        F.col("hour").cast("string").alias("field"),
        "value",
    )


def hourly_series(percentiles: DataFrame, day: str = "2025-01-01") -> DataFrame:
    """Count and percentiles on the hours of a fixed day; an hour outside 0..23 is an error."""
    return _tall(percentiles, ["airline", "hour"], HOURLY_MEASURES).select(
        _key("q3", "ts", F.col("metric"), F.col("airline")).alias("key"),
        "metric",
        "airline",
        hour_start("hour", day).alias("ts"),
        "value",
    )


def extreme_rows(extremes: DataFrame) -> DataFrame:
    return extremes.select(_key("q3", "minmax", F.col("airline")).alias("key"), "airline", *EXTREME_MEASURES)


def extreme_values(extremes: DataFrame) -> DataFrame:
    """Smallest and largest delay as (key, airline, value)."""
    return _tall(extremes, ["airline"], EXTREME_MEASURES).select(
        _key("q3", "metric", F.col("metric")).alias("key"), F.col("airline").alias("field"), "value"
    )


# --- series ---------------------------------------------------------------------------


def latest_points(points: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """One value per key: that of the highest ``order``. Combines on the map side."""
    return points.groupBy(*keys).agg(F.max_by(value, order).alias(value), F.max(order).alias(order))


def wide_series(series: DataFrame, metric: str, airlines: Sequence[str], label: str | None = "MMM") -> DataFrame:
    """One row per time with a column per airline, NULL where an airline has no point.

    The outer join of one metric's series on time, written as a pivot over known airlines.
    """
    wide = (
        series.where((F.col("metric") == metric) & F.col("airline").isin(list(airlines)))
        .groupBy("ts")
        .pivot("airline", list(airlines))
        .agg(F.max("value"))
    )
    return wide.withColumn("label", F.date_format("ts", label)) if label else wide


# --- rows as JSON ---------------------------------------------------------------------


def json_rows(df: DataFrame, key: str | Column, field: Column) -> DataFrame:
    """Each row as (key, field, payload); NULLs stay visible in the JSON payload."""
    return df.select(
        (F.lit(key) if isinstance(key, str) else key).alias("key"),
        field.cast("string").alias("field"),
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("payload"),
    )


def parse_json_rows(rows: DataFrame, schema: StructType | str, drop: Iterable[str] = (),
                    rename: dict[str, str] | None = None) -> DataFrame:
    """Payloads back as typed columns, without ``drop``, under the ``rename`` names."""
    parsed = rows.select(F.from_json("payload", schema).alias("r")).select("r.*").drop(*drop)
    return parsed.withColumnsRenamed(rename or {})


def metadata_row(spark: SparkSession, key: str, details: dict[str, str]) -> DataFrame:
    """One JSON row about a publication: when it was made, and the given details."""
    parts = [F.lit(value).alias(name) for name, value in details.items()]
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at")
    return json_rows(spark.range(1).select(stamp, *parts), key, F.lit("metadata"))
