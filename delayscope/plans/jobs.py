"""End-to-end jobs: files in, result tables out.

A job reads its facts once. Where two results come from the same facts, the small table
both need is written first and read back, which also survives a lost executor; nothing is
cached and no row count is run beside the write.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayscope.operators import carriers, feeds, hourly, monthly, quality
from delayscope.operators.cleaning import clean_flights
from delayscope.schema import (
    CARRIER_MEASURES,
    EXTREME_MEASURES,
    FLAGS,
    HOURLY_KEYS,
    MONTHLY_COUNTS,
    MONTHLY_KEYS,
    MONTHLY_MEASURES,
    PERCENTILE_COLUMNS,
)
from delayscope.sinks import files as sinks
from delayscope.sinks.scratch import discard, scratch_path
from delayscope.sources import files as sources

MONTHLY = "query1_monthly_stats"
ALL_CARRIERS = "query2_all_airlines_stats"
TOP_CARRIERS = "query2_top10_arrival_delay"
PERCENTILES = "query3_hourly_percentiles"
EXTREMES = "query3_global_minmax"
_CARRIER_SCHEMA = "carrier string, num_flights bigint, " + ", ".join(f"{c} double" for c in CARRIER_MEASURES[1:])
SCHEMAS = {
    MONTHLY: "month int, airline string, "
    + ", ".join([*(f"{c} bigint" for c in MONTHLY_COUNTS), *(f"{c} double" for c in MONTHLY_MEASURES)]),
    ALL_CARRIERS: _CARRIER_SCHEMA,
    TOP_CARRIERS: _CARRIER_SCHEMA,
    PERCENTILES: "airline string, hour int, num_flights bigint, "
    + ", ".join(f"{c} double" for c in PERCENTILE_COLUMNS),
    EXTREMES: "airline string, " + ", ".join(f"{c} double" for c in EXTREME_MEASURES),
}
RESULT_NAMES = [MONTHLY, ALL_CARRIERS, TOP_CARRIERS, PERCENTILES, EXTREMES]


def _stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A result read back with its types. Its values are rounded, so text holds them exactly."""
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return reader.schema(SCHEMAS[name]).csv(f"{folder}/{name}")


def clean_job(spark: SparkSession, raw_path: str, processed_path: str, partition_by: str | None = None) -> int:
    """Raw CSV to processed Parquet; the number of rows written."""
    return sinks.write_processed(clean_flights(sources.read_raw(spark, raw_path)), processed_path, partition_by)


def monthly_job(spark: SparkSession, processed_path: str, out: str,
                chosen: Sequence[str] | None = monthly.DEFAULT_CARRIERS) -> None:
    columns = ["MONTH", "OP_UNIQUE_CARRIER", "DEP_DELAY", "ARR_DELAY", "CANCELLED"]
    stats = monthly.monthly_stats(sources.read_processed(spark, processed_path, columns), chosen)
    sinks.write_csv(stats, f"{out}/{MONTHLY}", order_by=list(reversed(MONTHLY_KEYS)), single_file=True)


def carriers_job(spark: SparkSession, processed_path: str, out: str, k: int = carriers.TOP_K,
                 min_flights: int = carriers.MIN_FLIGHTS) -> None:
    """Statistics of all carriers, and the ranking read off the stored statistics."""
    stats = carriers.carrier_stats(sources.read_processed(spark, processed_path))
    sinks.write_csv(stats, f"{out}/{ALL_CARRIERS}", order_by=["carrier"], single_file=True)
    # A top-k comes out of one task in order, so it needs no further sorting.
    sinks.write_csv(carriers.top_carriers(_stored(spark, out, ALL_CARRIERS), k, min_flights), f"{out}/{TOP_CARRIERS}")


def hourly_job(spark: SparkSession, processed_path: str, out: str,
               chosen: Sequence[str] | None = hourly.DEFAULT_CARRIERS,
               probabilities: Sequence[float] = hourly.PROBABILITIES) -> None:
    """Percentiles and extremes from one stored table of counted delays."""
    columns = ["OP_UNIQUE_CARRIER", "CRS_DEP_TIME", "DEP_DELAY", FLAGS[0]]
    departures = hourly.hourly_departures(sources.read_processed(spark, processed_path, columns), chosen)
    stored = scratch_path(spark, "delay-counts")
    hourly.delay_counts(departures).write.parquet(stored)
    counts = spark.read.parquet(stored)
    sinks.write_csv(
        hourly.percentiles_from_counts(counts, probabilities), f"{out}/{PERCENTILES}", HOURLY_KEYS, single_file=True
    )
    sinks.write_csv(hourly.extremes_from_counts(counts), f"{out}/{EXTREMES}", ["airline"], single_file=True)
    discard(spark, stored)


def quality_job(spark: SparkSession, raw_path: str, out: str) -> None:
    """The whole quality profile of raw CSV files, one table per report."""
    parsed = scratch_path(spark, "parsed-flights")
    # Text is parsed once; every report then reads only the columns it needs.
    sources.with_source_file(sources.read_raw(spark, raw_path)).write.parquet(parsed)
    raw = spark.read.parquet(parsed)
    quality.quality_profile(raw).write.mode("overwrite").parquet(f"{out}/profile")
    quality.row_counts(raw).write.mode("overwrite").parquet(f"{out}/row_counts")
    quality.duplicate_audit(raw).write.mode("overwrite").parquet(f"{out}/duplicates")
    quality.examples(raw).write.mode("overwrite").parquet(f"{out}/examples")
    quality.missing_causes(raw, "source_file").write.mode("overwrite").parquet(f"{out}/missing_causes")
    discard(spark, parsed)


def results_status(spark: SparkSession, out: str) -> DataFrame:
    """Rows and part files of each result; an error when one is absent."""
    return sinks.output_status(spark, {name: ("csv", f"{out}/{name}") for name in RESULT_NAMES})


def feeds_job(spark: SparkSession, results: str, out: str, year: int = 2025,
              months: Sequence[int] = (1, 2, 3, 4)) -> None:
    """Serving tables from the stored results: values, series, and one table of keyed rows per result."""
    one, two, three, four = (
        _stored(spark, results, name) for name in (MONTHLY, TOP_CARRIERS, PERCENTILES, EXTREMES)
    )

    def publish(values: DataFrame, feed: str) -> None:
        # Names and numbers share the value column, so it holds text.
        sinks.publish_feed(values.withColumn("value", F.col("value").cast("string")), f"{out}/values", feed)

    publish(feeds.monthly_values(one), "q1")
    ranked = feeds.ranked_carriers(two)
    publish(feeds.ranked_values(ranked), "q2")
    publish(feeds.hourly_values(three).unionByName(feeds.extreme_values(four)), "q3")
    sinks.publish_feed(feeds.monthly_series(one, year, months), f"{out}/series", "q1")
    sinks.publish_feed(feeds.hourly_series(three, f"{year}-01-01"), f"{out}/series", "q3")
    rows = {
        "monthly_rows": feeds.monthly_rows(one), "ranked_rows": feeds.ranked_rows(ranked), "hourly_rows": feeds.hourly_rows(three),
        "extreme_rows": feeds.extreme_rows(four), "cause_shares": feeds.cause_shares(ranked),
    }
    for name, keyed in rows.items():
        keyed.write.mode("overwrite").parquet(f"{out}/{name}")
