"""One runnable query per operator, over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayscope.functions import bad_minutes, hour_of, number, number_or_zero, thousands, whole, whole_or_zero
from delayscope.operators import carriers, compare, digest, feeds, hourly, monthly, night, quality, running_quality, timings
from delayscope.operators.cleaning import clean_flights
from delayscope.schema import HOURLY_KEYS, PROCESSED_COLUMNS, RAW_SCHEMA
from delayscope.sinks import files as sinks
from delayscope.sinks import upserts, versions
from delayscope.sinks.scratch import scratch_path
from delayscope.sources import files as sources
from delayscope.sources.archives import read_archives
from delayscope.streaming.landing import ingest_available, ingest_when_quiet, poll_landing
from verification import inputs

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}

ALL_MONTHS = range(1, 13)


def query(fn: Query) -> Query:
    """Registers a query under its function's name, less a final underscore."""
    REGISTRY[fn.__name__.removesuffix("_")] = fn
    return fn


def _dealt(spark, sf, parts: int) -> Callable[[Sequence[int]], DataFrame]:
    """Raw flights dealt into parts by the hash of a row, and stored: gives the rows of some parts.

    The view is worked out once, whatever the number of parts, and a part is a plain filter.
    """
    raw, path = inputs.raw_flights(spark, sf), scratch_path(spark, "dealt")
    raw.withColumn("_part", F.pmod(F.xxhash64(*raw.columns), F.lit(parts))).write.parquet(path)
    stored = spark.read.parquet(path)
    return lambda ks: stored.where(F.col("_part").isin(list(ks))).drop("_part")


# --- sources and sinks ----------------------------------------------------------------


@query
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_csv(inputs.raw_flights(spark, sf), path)
    return sources.read_raw(spark, path)


@query
def csv_by_name(spark, sf):
    path = scratch_path(spark, "by-name")
    raw = inputs.raw_flights(spark, sf)
    sinks.write_csv(raw.select(*reversed(raw.columns)), path)
    return sources.read_by_name(spark, path).select(*PROCESSED_COLUMNS)


@query
def result_readback(spark, sf):
    path = scratch_path(spark, "result")
    stats = carriers.carrier_stats(inputs.flights(spark, sf))
    sinks.write_csv(stats, path, order_by=["carrier"], single_file=True)
    return sources.read_result(spark, path)


def _tar_rows(batches):
    """Every batch of CSV lines as a member of a tar stream, beside files to ignore.

    A row is a header block, the content and its padding less one byte: the line feed that the
    text writer adds completes the block.
    """
    import io
    import tarfile

    import pandas as pd

    def member(name, content):
        if len(content) % 512 == 0:
            content += b"\n"
        entry = tarfile.TarInfo(name)
        entry.size = len(content)
        padding = b"\0" * (511 - len(content) % 512)
        return (entry.tobuf(tarfile.USTAR_FORMAT) + content + padding).decode()

    for i, batch in enumerate(batches):
        data = "\n".join([",".join(RAW_SCHEMA.fieldNames()), *batch["line"], ""]).encode()
        names = {f"data/flights_{i}.csv": data, f"data/.flights_{i}.csv": data, f"data/notes_{i}.txt": b"no table"}
        yield pd.DataFrame({"value": [member(n, c) for n, c in names.items()]})
    yield pd.DataFrame({"value": ["\0" * 1023]})


@query
def ingest_filter(spark, sf):
    """Flights packed into compressed archives beside files to ignore, streamed out and cleaned."""
    raw = inputs.raw_flights(spark, sf)
    lines = raw.select(F.to_csv(F.struct(*raw.columns)).alias("line"))
    path = scratch_path(spark, "archives")
    lines.mapInPandas(_tar_rows, "value string").write.option("compression", "gzip").text(path)
    return clean_flights(sources.convert_raw(read_archives(spark, path, name_pattern="*.gz")))


@query
def ingest_incremental(spark, sf):
    landing, table, done = (scratch_path(spark, part) for part in ("landing", "table", "progress"))
    sinks.write_csv(inputs.raw_flights(spark, sf), landing)
    ingest_available(spark, landing, table, done)
    return sources.read_processed(spark, table)


@query
def ingest_when_complete(spark, sf):
    """Files land in three drops; rows are taken in only when all are there, four at least, and three rounds were quiet.

    A part of a drop is as many files as tasks write it, one on a small table.
    """
    landing, notes, table, done = (scratch_path(spark, part) for part in ("landing", "notes", "table", "progress"))
    rows = _dealt(spark, sf, 4)
    number = 0
    for drop in ([0, 1], [2], [3]):
        for k in drop:
            rows([k]).write.mode("append").option("header", True).csv(landing)
        for _ in range(4):
            poll_landing(spark, landing, notes, number)
            number += 1
    ingest_when_quiet(spark, notes, table, done, least_files=sources.require_landed(spark, landing))
    return sources.read_processed(spark, table)


@query
def csv_one_file(spark, sf):
    """All flights through one ordered file, written in parallel and joined by the file system."""
    path = scratch_path(spark, "one-file")
    sinks.write_csv(inputs.raw_flights(spark, sf), path, order_by=["YEAR", "MONTH", "DAY_OF_MONTH"], single_file=True)
    return sources.read_raw(spark, path)


@query
def csv_by_name_mixed(spark, sf):
    """Files of three column orders, one with a column more, in one folder."""
    path = scratch_path(spark, "by-name-mixed")
    rows, names = _dealt(spark, sf, 3), RAW_SCHEMA.fieldNames()
    shapes = [names, list(reversed(names)), [F.lit("x").alias("EXTRA"), *sorted(names)]]
    for k, shape in enumerate(shapes):
        rows([k]).select(*shape).write.mode("append").option("header", True).csv(path)
    return sources.read_by_name(spark, path).select(*PROCESSED_COLUMNS)


@query
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "parquet")
    sinks.write_processed(inputs.flights(spark, sf), path, partition_by="OP_UNIQUE_CARRIER")
    return sources.read_processed(spark, path, PROCESSED_COLUMNS)


@query
def output_ready(spark, sf):
    facts, results = scratch_path(spark, "facts"), scratch_path(spark, "results")
    sinks.write_processed(inputs.flights(spark, sf), facts)
    stats = monthly.monthly_stats(sources.read_processed(spark, facts))
    sinks.write_csv(stats, results, order_by=["airline", "month"], single_file=True)
    status = sinks.output_status(spark, {"processed": ("parquet", facts), "monthly": ("csv", results)})
    return status.select("output", "rows", "ready")


@query
def feed_republish(spark, sf):
    """Feeds published, one again, one emptied: the others stay, nothing doubles or is left over."""
    path = scratch_path(spark, "feeds")
    flights = inputs.flights(spark, sf)
    points = feeds.monthly_values(monthly.monthly_stats(flights))
    extremes = feeds.extreme_values(hourly.delay_extremes(flights))
    sinks.publish_feed(points, path, "q1")
    sinks.publish_feed(extremes, path, "q3")
    sinks.publish_feed(points, path, "q1")
    sinks.publish_feed(extremes, path, "gone")
    sinks.publish_feed(extremes.limit(0), path, "gone")
    return spark.read.parquet(path)


@query
def feed_versions(spark, sf):
    """Feeds replaced in one step: a version that is written but not yet published is not seen."""
    path = scratch_path(spark, "versioned-feeds")
    flights = inputs.flights(spark, sf)
    points = feeds.monthly_values(monthly.monthly_stats(flights))
    extremes = feeds.extreme_values(hourly.delay_extremes(flights))
    versions.publish_feed_version(points.where("value > 0"), path, "q1")
    versions.publish_feed_version(extremes, path, "q3")
    versions.publish_feed_version(points, path, "q1")
    versions.write_version(points.where("value < 0"), f"{path}/q1")
    return versions.read_feeds(spark, path, ["q1", "q3"])


@query
def feed_upsert(spark, sf):
    """A stored series brought up to date three times, the oldest events last of all."""
    path = scratch_path(spark, "series")
    events = inputs.table(spark, sf, "events").select(
        "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "event_id", "value"
    )
    part = F.col("event_id") % 10
    for chosen in (part.between(3, 6), part > 6, part < 3):
        upserts.upsert_points(events.where(chosen), path, ["event_type", "ts"], "value", "event_id", buckets=16)
    return upserts.read_points(spark, path)


# --- cleaning and expressions ---------------------------------------------------------


@query
def clean_flights_(spark, sf):
    return clean_flights(inputs.raw_flights(spark, sf))


@query
def dq_coerce(spark, sf):
    return inputs.text_log(spark, sf).select(
        "event_id",
        number("time_s").alias("time_value"),
        number_or_zero("time_s").alias("time_or_zero"),
        whole("worker_count").alias("workers"),
        whole_or_zero("worker_count").alias("workers_or_zero"),
        whole_or_zero((F.col("event_id") * 3_000_000_000).cast("string")).alias("large"),
    )


@query
def hhmm_hour(spark, sf):
    return (
        inputs.raw_flights(spark, sf)
        .groupBy("CRS_DEP_TIME")
        .agg(F.count(F.lit(1)).alias("flights"))
        .select(
            F.col("CRS_DEP_TIME").alias("crs_dep_time"),
            hour_of("CRS_DEP_TIME").alias("hour"),
            bad_minutes("CRS_DEP_TIME").alias("bad_minutes"),
            "flights",
        )
    )


# --- the three analyses ---------------------------------------------------------------


@query
def q1_monthly_stats(spark, sf):
    return monthly.monthly_stats(inputs.flights(spark, sf))


@query
def q1_via_join(spark, sf):
    return monthly.monthly_stats_joined(inputs.flights(spark, sf))


@query
def q2_carrier_stats(spark, sf):
    return carriers.carrier_stats(inputs.flights(spark, sf))


@query
def q2_top10(spark, sf):
    return carriers.top_carriers(carriers.carrier_stats(inputs.flights(spark, sf)))


@query
def q3_hourly_percentiles(spark, sf):
    return hourly.hourly_percentiles(inputs.flights(spark, sf))


@query
def q3_hourly_percentiles_approx(spark, sf):
    return hourly.hourly_percentiles_approx(inputs.flights(spark, sf), accuracy=10_000)


@query
def q3_exact_interp(spark, sf):
    return hourly.hourly_percentiles_interpolated(inputs.flights(spark, sf))


@query
def q3_minmax(spark, sf):
    return hourly.delay_extremes(inputs.flights(spark, sf))


@query
def q3_sketch(spark, sf):
    """One digest per month, rolled up to (airline, hour) and read."""
    departures = hourly.hourly_departures(inputs.flights(spark, sf), keep=["MONTH"])
    by_month = digest.digest_by(departures, HOURLY_KEYS, "MONTH", "DEP_DELAY")
    rolled = digest.merge_digests(by_month, HOURLY_KEYS)
    return digest.read_digests(rolled, HOURLY_KEYS, hourly.PROBABILITIES).withColumnRenamed("n", "num_flights")


@query
def q3_digest_ranks(spark, sf):
    """Digests of tasks merged per month and rolled up, judged by the stated bound on ranks."""
    departures = hourly.hourly_departures(inputs.flights(spark, sf), keep=["MONTH"])
    by_month = digest.build_digests(departures, [*HOURLY_KEYS, "MONTH"], "DEP_DELAY")
    estimates = digest.read_digests(digest.merge_digests(by_month, HOURLY_KEYS), HOURLY_KEYS, hourly.PROBABILITIES, digits=None)
    checked = digest.digest_rank_check(departures, estimates, HOURLY_KEYS, "DEP_DELAY", hourly.PROBABILITIES, levels=4)
    return checked.withColumnRenamed("n", "num_flights")


@query
def q3_sketch_ranks(spark, sf):
    """Sketches kept per month, rolled up, and judged by the rank of what they return."""
    flights = inputs.flights(spark, sf)
    monthly_sketches = hourly.delay_sketches(flights, by=["MONTH"])
    estimates = hourly.read_sketches(hourly.merge_sketches(monthly_sketches))
    return hourly.sketch_rank_check(flights, estimates)


@query
def carrier_hourly_status(spark, sf):
    return night.hourly_status(inputs.flights(spark, sf))


@query
def night_flights(spark, sf):
    return night.night_flights(inputs.flights(spark, sf))


@query
def crs_time_range(spark, sf):
    return night.clock_range(inputs.flights(spark, sf))


# --- data quality ---------------------------------------------------------------------


@query
def dq_status(spark, sf):
    return quality.status_report(inputs.raw_flights(spark, sf))


@query
def dq_delays(spark, sf):
    return quality.delay_report(inputs.raw_flights(spark, sf))


@query
def dq_delay_bands(spark, sf):
    return quality.delay_bands(inputs.raw_flights(spark, sf))


@query
def dq_cause_nulls(spark, sf):
    return quality.cause_nulls(inputs.raw_flights(spark, sf))


@query
def dq_cause_reconcile(spark, sf):
    return quality.cause_reconcile(inputs.raw_flights(spark, sf))


@query
def dq_missing_causes(spark, sf):
    return quality.missing_causes(inputs.raw_flights(spark, sf), per="MONTH")


@query
def dq_hhmm(spark, sf):
    return quality.clock_report(inputs.raw_flights(spark, sf))


@query
def dq_row_counts(spark, sf):
    return quality.row_counts(inputs.raw_flights(spark, sf))


@query
def dq_duplicates(spark, sf):
    return quality.duplicate_audit(inputs.raw_flights(spark, sf))


@query
def dq_examples(spark, sf):
    return quality.examples(inputs.raw_flights(spark, sf))


@query
def dq_profile(spark, sf):
    return quality.quality_profile(inputs.raw_flights(spark, sf))


@query
def dq_running(spark, sf):
    """The profile from states per file, after two increments and a file that was replaced."""
    landing, root = scratch_path(spark, "quality-landing"), scratch_path(spark, "quality-states")
    rows = _dealt(spark, sf, 3)

    def land(k, rows):
        sinks.write_csv(rows, f"{landing}/{k}", single_file=True)

    def update():
        return running_quality.update_states(
            spark, sources.landed_files(spark, landing), lambda paths: sources.read_raw(spark, paths), root
        )

    land(0, rows([0]))
    land(1, rows([0, 1]))
    update()
    land(1, rows([1]))
    land(2, rows([2]))
    update()
    return running_quality.profile_of(running_quality.states_at(spark, root))


@query
def dq_number_texts(spark, sf):
    """Row counts and mean delays per carrier as grouped number texts."""
    grouped = inputs.flights(spark, sf).groupBy("OP_UNIQUE_CARRIER").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ARR_DELAY").alias("minutes")
    )
    return grouped.select(
        F.col("OP_UNIQUE_CARRIER").alias("carrier"),
        thousands("n").alias("flights_text"),
        thousands("minutes", 2).alias("minutes_text"),
    )


# --- comparison -----------------------------------------------------------------------


def _perturbed(stats: DataFrame) -> DataFrame:
    """One carrier gone, one renamed, one repeated, one clearly and one barely different."""
    carrier, mean = F.col("carrier"), F.col("arrdelay_mean")
    copies = F.when(carrier == "OO", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    changed = stats.where(carrier != "AA").withColumn("_copy", F.explode(copies)).drop("_copy")
    return changed.withColumns(
        {
            "carrier": F.when(carrier == "DL", "D2").otherwise(carrier),
            "arrdelay_mean": mean
            + F.when(carrier == "UA", 1.0).when(carrier == "WN", 0.00001).otherwise(0.0),
        }
    )


@query
def result_diff(spark, sf):
    stats = carriers.carrier_stats(inputs.flights(spark, sf))
    return compare.diff_results(stats, _perturbed(stats), *compare.RESULTS["carriers"])


@query
def result_key_sets(spark, sf):
    stats = carriers.carrier_stats(inputs.flights(spark, sf))
    return compare.key_sets(stats, _perturbed(stats), ["carrier"])


@query
def result_order(spark, sf):
    top = carriers.top_carriers(carriers.carrier_stats(inputs.flights(spark, sf)))
    ranked = feeds.ranked_carriers(top).select("rank", "carrier")
    swapped = ranked.withColumn("rank", F.when(F.col("rank") == 2, 3).when(F.col("rank") == 3, 2).otherwise(F.col("rank")))
    return compare.diff_order(ranked, swapped, ["carrier"], "rank")


# --- feeds ----------------------------------------------------------------------------


@query
def feed_q1_rows(spark, sf):
    return feeds.monthly_rows(monthly.monthly_stats(inputs.flights(spark, sf)))


@query
def feed_q1_values(spark, sf):
    return feeds.monthly_values(monthly.monthly_stats(inputs.flights(spark, sf)))


@query
def feed_q1_series(spark, sf):
    return feeds.monthly_series(monthly.monthly_stats(inputs.flights(spark, sf)), months=ALL_MONTHS)


@query
def feed_q1_wide(spark, sf):
    series = feeds.monthly_series(monthly.monthly_stats(inputs.flights(spark, sf)), months=ALL_MONTHS)
    return feeds.wide_series(series, "dep_delay_mean", ["AA", "DL"])


def _ranked(spark, sf):
    return feeds.ranked_carriers(carriers.top_carriers(carriers.carrier_stats(inputs.flights(spark, sf))))


@query
def feed_q2_ranked(spark, sf):
    return feeds.ranked_rows(_ranked(spark, sf))


@query
def feed_q2_values(spark, sf):
    return feeds.ranked_values(_ranked(spark, sf))


@query
def feed_cause_share(spark, sf):
    return feeds.cause_shares(_ranked(spark, sf))


@query
def feed_q3_rows(spark, sf):
    return feeds.hourly_rows(hourly.hourly_percentiles(inputs.flights(spark, sf)))


@query
def feed_q3_values(spark, sf):
    return feeds.hourly_values(hourly.hourly_percentiles(inputs.flights(spark, sf)))


@query
def feed_q3_series(spark, sf):
    return feeds.hourly_series(hourly.hourly_percentiles(inputs.flights(spark, sf)))


@query
def feed_q3_wide(spark, sf):
    series = feeds.hourly_series(hourly.hourly_percentiles(inputs.flights(spark, sf)))
    return feeds.wide_series(series, "p90", hourly.DEFAULT_CARRIERS, label=None)


@query
def feed_q3_minmax(spark, sf):
    return feeds.extreme_rows(hourly.delay_extremes(inputs.flights(spark, sf)))


@query
def feed_last_wins(spark, sf):
    events = inputs.table(spark, sf, "events").select(
        "event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"), "event_id", "value"
    )
    return feeds.latest_points(events, ["event_type", "ts"], "value", "event_id")


# The columns of a stored report, and how a feed shows them.
JSON_SCHEMA = (
    "worker_count int, query string, impl string, phase string, n bigint, mean_s double, "
    "std_s double, median_s double, min_s double, max_s double, algorithm string, note string"
)
SHOWN_AS = {
    "worker_count": "Worker Count", "query": "Query", "impl": "Format", "phase": "Phase", "n": "Iterations",
    "mean_s": "Mean", "std_s": "Std Dev", "median_s": "Median", "min_s": "Min", "max_s": "Max",
}


@query
def feed_json_rows(spark, sf):
    stats = timings.phase_stats(inputs.phase_log(spark, sf)).withColumns(
        {
            "algorithm": timings.algorithm_name(F.col("query"), F.col("impl")),
            "note": timings.phase_note(F.col("phase")),
        }
    )
    field = F.concat_ws(":", "query", "impl", "worker_count", "phase")
    rows = feeds.json_rows(stats, "bench:table:aggregate", field)
    return feeds.parse_json_rows(rows, JSON_SCHEMA, drop=["algorithm", "note"], rename=SHOWN_AS)


# --- timing logs ----------------------------------------------------------------------


def _phase_stats(spark, sf):
    return timings.phase_stats(inputs.phase_log(spark, sf))


@query
def bench_normalise(spark, sf):
    rows = timings.normalise_iterations(inputs.text_log(spark, sf))
    return rows.withColumns(
        {
            "algorithm": timings.algorithm_name(F.col("query"), F.col("impl")),
            "note": timings.phase_note(F.col("phase")),
        }
    )


@query
def bench_normalise_stats(spark, sf):
    """Statistics rows rendered as text, as a CSV report holds them, and read back."""
    stats = timings.phase_stats(inputs.phase_log(spark, sf))
    texts = stats.select(*(F.concat(F.lit(" "), F.col(c).cast("string")).alias(c) for c in stats.columns))
    return timings.normalise_stats(texts)


@query
def bench_stats(spark, sf):
    return timings.phase_stats(inputs.tlog(spark, sf))


@query
def bench_report(spark, sf):
    return timings.phase_report(_phase_stats(spark, sf), total_iterations=20, warmup_iterations=5)


@query
def bench_stats_raw(spark, sf):
    rows = timings.phase_stats(
        inputs.tlog(spark, sf), digits=None, single_std=None
    )
    return rows.withColumn("std_s", F.round("std_s", 6))


@query
def bench_boxstats(spark, sf):
    return timings.box_stats(inputs.tlog(spark, sf))


@query
def bench_box_rows(spark, sf):
    log = inputs.tlog(spark, sf).withColumnRenamed("run_id", "iteration")
    return timings.box_rows(log)


@query
def bench_warmup_drop(spark, sf):
    """Runs of several phases each, at several worker counts."""
    log = inputs.tlog(spark, sf).withColumn("run_id", F.expr("run_id div 60"))
    return timings.drop_warmup(log, warmup=5, bucket=65_536)


@query
def bench_union(spark, sf):
    log = inputs.tlog(spark, sf)
    first = log.where(F.col("impl") == "df")
    second = log.where(F.col("impl") == "rdd").drop("run_id")
    return timings.stack_reports([first, second])


@query
def bench_workers(spark, sf):
    return timings.worker_counts(inputs.tlog(spark, sf))


@query
def bench_processing(spark, sf):
    return timings.processing_times(_phase_stats(spark, sf))


@query
def bench_processing_runs(spark, sf):
    log = inputs.phase_log(spark, sf)
    keys = [*timings.GROUP, "iteration"]
    runs = log.groupBy(*keys, "phase").agg(F.max("time_s").alias("time_s"))
    return timings.processing_times(runs, keys, "time_s")


@query
def bench_processing_join(spark, sf):
    return timings.processing_times_joined(_phase_stats(spark, sf))


@query
def bench_total(spark, sf):
    parts = ["loading_s", "filtering_s", "computation_s"]
    return timings.total_time(inputs.phase_log(spark, sf), parts)


@query
def bench_compare(spark, sf):
    return timings.compare_implementations(_phase_stats(spark, sf))


@query
def bench_compare_phases(spark, sf):
    stats = timings.phase_stats(inputs.phase_log(spark, sf), keys=["query", "impl", "phase"])
    return timings.compare_implementations(stats, ["query", "phase"], timings.COMPARED_PHASES)


@query
def bench_cold_vs_warm(spark, sf):
    stats = timings.phase_stats(inputs.phase_log(spark, sf), keys=["impl", "query", "phase"])
    cold, warm = (stats.where(F.col("impl") == impl).drop("impl") for impl in timings.IMPLEMENTATIONS)
    return timings.cold_vs_warm(cold, warm)


@query
def bench_phase_order(spark, sf):
    stats = timings.phase_stats(inputs.phase_log(spark, sf), keys=["query", "phase"])
    return timings.phase_summary(timings.normalise_phase_report(stats))


@query
def bench_phase_breakdown(spark, sf):
    return timings.phase_breakdown(_phase_stats(spark, sf), worker_count=2)


@query
def bench_scaling_table(spark, sf):
    return timings.scaling_table(_phase_stats(spark, sf), "end_to_end_s", [1, 2, 3, 4])


@query
def bench_wide_line(spark, sf):
    return timings.wide_lines(_phase_stats(spark, sf), "end_to_end_s")


@query
def bench_wide_line_processing(spark, sf):
    return timings.wide_lines(timings.processing_times(_phase_stats(spark, sf)), "processing_s")


@query
def bench_missing(spark, sf):
    return timings.missing_combinations(inputs.tlog(spark, sf), ["end_to_end_s", "processing_s"])
