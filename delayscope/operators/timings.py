"""Statistics over timing logs of (worker_count, query, impl, iteration, phase, time_s)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from delayscope.functions import (
    binary_round,
    clean_text,
    first_filled,
    mean_std_text,
    number,
    number_text,
    whole,
    whole_or_zero,
)
from delayscope.operators import percentiles as pct
from delayscope.operators.ranking import number_rows
from delayscope.sources.contract import require_columns

# --- fixed values: codes and labels of the timing tables ---

QUERIES = ["Q1", "Q2", "Q3"]
IMPLEMENTATIONS = ["df", "rdd"]
IMPLEMENTATION_LABELS = {"df": "DataFrame", "rdd": "RDD"}

STATS = ["n", "mean_s", "std_s", "median_s", "min_s", "max_s"]

PHASE_LABELS = {
    "spark_start_s": "Spark start",
    "loading_s": "Loading",
    "filtering_s": "Filtering",
    "computation_s": "Computation",
    "all_airlines_computation_s": "All-airlines computation",
    "top10_computation_s": "Top-10 computation",
    "computation_percentiles_s": "Percentiles computation",
    "computation_minmax_s": "Min/max computation",
    "output_s": "Output",
    "total_s": "Total",
    "wall_total_s": "Wall total",
    "end_to_end_s": "End-to-end",
    "spark_stop_s": "Spark stop",
}
# A phase ranks where it stands above; one not listed comes after all of them.
UNKNOWN_RANK = 999

SERVED_ALGORITHMS = {"df": "Spark DataFrame", "rdd": "Spark RDD"}
SERVED_SPECIAL = {("Q3", "rdd"): "RDD + t-digest"}

REPORT_TECHNIQUES = {
    ("Q1", "df"): "groupBy+agg",
    ("Q1", "rdd"): "combineByKey",
    ("Q2", "df"): "groupBy+agg",
    ("Q2", "rdd"): "combineByKey",
    ("Q3", "df"): "percentile_approx (Greenwald-Khanna, Spark native)",
    ("Q3", "rdd"): "t-digest (aggregateByKey, merge sul driver)",
}

PHASE_NOTES = {
    "end_to_end_s": "includes output",
    "computation_percentiles_s": "Q3 percentile computation",
    "computation_s": "main computation phase",
}

DIRECT_PHASES = {
    "spark_start_s": "Spark start",
    "loading_s": "Loading",
    "processing_s": "Processing",
    "wall_total_s": "End-to-end",
    "spark_stop_s": "Spark stop",
}

BREAKDOWN_PHASES = ["loading_s", "filtering_s", "processing_s", "output_s", "end_to_end_s"]

COMPARED_PHASES = [
    "loading_s", "filtering_s", "computation_s", "computation_percentiles_s",
    "computation_minmax_s", "output_s", "end_to_end_s",
]

# --- end of fixed values ---

GROUP = ["worker_count", "query", "impl"]
FEW = 5


def _lookup(values: dict[str, object], column: str | Column, otherwise: Column) -> Column:
    table = F.create_map(*(F.lit(part) for pair in values.items() for part in pair))
    return F.coalesce(table[F.col(column) if isinstance(column, str) else column], otherwise)


def phase_rank(phase: str | Column = "phase") -> Column:
    """Place of a phase in a report; unknown phases go last."""
    return _lookup({name: i for i, name in enumerate(PHASE_LABELS)}, phase, F.lit(UNKNOWN_RANK))


def query_rank(query: str | Column = "query") -> Column:
    """The number in a query name; names without one go last."""
    found = F.regexp_extract(query, r"Q(\d+)", 1)
    return F.coalesce(found.try_cast("int"), F.lit(UNKNOWN_RANK))


def phase_label(phase: str | Column = "phase") -> Column:
    return _lookup(PHASE_LABELS, phase, F.col(phase) if isinstance(phase, str) else phase)


def implementation_label(impl: str | Column = "impl") -> Column:
    return _lookup(IMPLEMENTATION_LABELS, impl, F.col(impl) if isinstance(impl, str) else impl)


def algorithm_name(query: Column, impl: Column) -> Column:
    """Algorithm shown in serving tables; blank for an unknown implementation."""
    special = [F.when((query == q) & (impl == i), text) for (q, i), text in SERVED_SPECIAL.items()]
    general = [F.when(impl == i, text) for i, text in SERVED_ALGORITHMS.items()]
    return F.coalesce(*special, *general, F.lit(""))


def phase_note(phase: Column) -> Column:
    return _lookup(PHASE_NOTES, phase, F.lit(""))


def output_note(phase: Column) -> Column:
    """Does the time of a phase include writing results?"""
    return F.when(phase.isin("output_s", "end_to_end_s"), "includes_output").otherwise("computation_only")


def technique_name(query: Column, impl: Column) -> Column:
    """How an implementation computes a query, as the stored reports name it."""
    named = [F.when((query == q) & (impl == i), text) for (q, i), text in REPORT_TECHNIQUES.items()]
    return F.coalesce(*named, F.lit(""))


# --- reading logs ---------------------------------------------------------------------


def _texts() -> dict[str, Column]:
    return {"query": F.upper(clean_text("query")), "impl": F.lower(clean_text("impl")), "phase": clean_text("phase")}


def normalise_iterations(rows: DataFrame) -> DataFrame:
    """Typed log rows; the run number may be called iteration, iteration_idx or run.

    Rows without a usable worker count or time are dropped, since no statistic can use
    them. A missing run number is 0.
    """
    require_columns(rows, ["worker_count", "query", "impl", "phase", "time_s"], "iterations")
    runs = [c for c in ("iteration", "iteration_idx", "run") if c in rows.columns]
    iteration = whole_or_zero(first_filled(*runs)) if runs else F.lit(0).cast("bigint")
    return rows.select(
        whole("worker_count").try_cast("int").alias("worker_count"),
        *(value.alias(name) for name, value in _texts().items()),
        iteration.alias("iteration"),
        number("time_s").alias("time_s"),
    ).dropna(subset=["worker_count", "time_s"])


def normalise_stats(rows: DataFrame) -> DataFrame:
    """Typed statistics rows with the derived algorithm and note."""
    require_columns(rows, [*GROUP, "phase", *STATS], "phase statistics")
    typed = rows.select(
        whole("worker_count").try_cast("int").alias("worker_count"),
        *(value.alias(name) for name, value in _texts().items()),
        whole("n").alias("n"),
        *(number(c).alias(c) for c in STATS[1:]),
    ).dropna(subset=["worker_count", "mean_s"])
    return typed.withColumns(
        {"algorithm": algorithm_name(F.col("query"), F.col("impl")), "note": phase_note(F.col("phase"))}
    )


def normalise_phase_report(rows: DataFrame) -> DataFrame:
    """Typed report rows of one session kind, with the ranks that order the report."""
    require_columns(rows, ["query", "phase", *STATS], "phase report")
    typed = rows.select(
        F.upper(clean_text("query")).alias("query"),
        clean_text("phase").alias("phase"),
        whole("n").alias("n"),
        *(number(c).alias(c) for c in STATS[1:]),
    ).dropna(subset=["mean_s"])
    return typed.withColumns({"phase_order": phase_rank(), "query_order": query_rank()})


def stack_reports(reports: Sequence[DataFrame]) -> DataFrame:
    """Reports of several runs as one table; columns a report lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), reports)


def read_reports(spark: SparkSession, pattern: str) -> DataFrame:
    """All report files a glob matches. Absent and empty files simply add no rows.

    Where nothing matches, a table of a report's columns without rows.
    """
    try:
        return spark.read.option("header", True).option("enforceSchema", False).csv(pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in (*GROUP, "phase", *STATS)))


def drop_warmup(log: DataFrame, warmup: int, keys: Sequence[str] = tuple(GROUP), run: str = "run_id",
                bucket: int = 1_000_000, numbered: bool = False) -> DataFrame:
    """Without the first ``warmup`` runs of each group, the others renumbered from 1.

    A run is a run id of a group; all its rows, one per phase, stay or go together. Only
    the distinct runs are numbered, bucket by bucket of the run id, and joined back to the
    rows. ``numbered`` says that run ids are 1, 2, 3, ... already in every group: then this
    is a filter. Rows without a run id belong to no run and go.
    """
    if numbered:
        place = F.col(run).cast("long")
        return log.where(place > warmup).select("*", (place - warmup).alias("iteration"))
    spot = F.struct(*keys, run)
    runs = number_rows(
        log.select(*keys, run).where(F.col(run).isNotNull()).distinct(), keys, [F.floor(F.col(run) / bucket)], [run], "_run"
    ).where(F.col("_run") > warmup).select(spot.alias("_spot"), (F.col("_run") - warmup).alias("iteration"))
    return log.withColumn("_spot", spot).join(runs, "_spot").select(*log.columns, "iteration")


# --- statistics -----------------------------------------------------------------------


def _described(log: DataFrame, keys: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Count, mean, sample deviation, extremes and percentiles of time_s.

    All but the percentiles are plain aggregates; those are selected by rank, so a group
    with raw timings is never put in order as a whole.
    """
    known = log.where(F.col("time_s").isNotNull())
    plain = known.groupBy(*keys).agg(
        F.avg("time_s").alias("mean_s"), F.stddev_samp("time_s").alias("std_s"), F.min("time_s").alias("min_s"), F.max("time_s").alias("max_s"),
    )
    found = pct.interpolated_by_rank(known, keys, "time_s", probabilities)
    named = plain.select(*(F.col(k).alias(f"_of_{k}") for k in keys), "mean_s", "std_s", "min_s", "max_s")
    return found.join(named, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]).drop(*(f"_of_{k}" for k in keys))


def phase_stats(log: DataFrame, keys: Sequence[str] = (*GROUP, "phase"), digits: int | None = 3,
                single_std: float | None = 0.0) -> DataFrame:
    """n, mean, sample deviation, median, min and max per group.

    ``digits=None`` leaves values unrounded; ``single_std`` is the deviation of a single
    observation (None for unknown).
    """
    found = _described(log, keys, [0.5]).withColumnRenamed("p50", "median_s")
    if single_std is not None:
        found = found.withColumn("std_s", F.coalesce("std_s", F.lit(single_std)))
    if digits is not None:
        found = found.withColumns({c: binary_round(c, digits) for c in STATS[1:]})
    return found.select(*keys, *STATS)


def phase_report(stats: DataFrame, total_iterations: int, warmup_iterations: int) -> DataFrame:
    """Phase statistics in the layout of a stored report."""
    return stats.select(
        *GROUP,
        technique_name(F.col("query"), F.col("impl")).alias("algorithm"),
        "phase",
        *STATS,
        F.lit(total_iterations).alias("total_iterations"),
        F.lit(warmup_iterations).alias("warmup_iterations"),
        F.lit(total_iterations - warmup_iterations).alias("valid_iterations"),
        output_note(F.col("phase")).alias("note"),
    )


def _slot(worker: str = "worker_count", impl: str = "impl") -> Column:
    """Place of a box on the axis: workers first, then implementation."""
    ranks = {name: i for i, name in enumerate(IMPLEMENTATIONS)}
    return (F.col(worker) * 10 + _lookup(ranks, impl, F.lit(9))).cast("int")


def _slot_label() -> Column:
    return F.concat(F.col("worker_count").cast("string"), F.lit("W "), F.col("impl"))


def _of_phase(log: DataFrame, phase: str) -> DataFrame:
    return log.where((F.col("phase") == phase) & F.col("query").isin(QUERIES))


def box_stats(log: DataFrame, phase: str = "end_to_end_s") -> DataFrame:
    """Five-number summary with interpolated quartiles per query, workers and implementation."""
    found = _described(_of_phase(log, phase), ["query", "worker_count", "impl"], [0.25, 0.5, 0.75])
    base = F.lit("2025-01-01").cast("timestamp_ntz")
    return found.select(
        (base + F.make_dt_interval(F.lit(0), F.lit(0), _slot())).alias("time"),
        "query", "worker_count", "impl",
        _slot_label().alias("group"),
        _slot().alias("group_order"),
        "n", "min_s",
        F.col("p25").alias("q1_s"), F.col("p50").alias("median_s"), F.col("p75").alias("q3_s"),
        "max_s",
    )


def box_rows(log: DataFrame, phase: str = "end_to_end_s", bucket: int = 1_000_000, width: float = 1 / 1024) -> DataFrame:
    """Every observation with its box and its 0-based place in the query's chart.

    Runs are numbered in buckets of ``bucket`` run numbers. Rows without a run number all
    have the number 0; they are cut by time, ``width`` seconds to a bucket, instead.
    """
    rows = _of_phase(log, phase).select(
        "query", "worker_count", "impl", "iteration", "time_s",
        _slot_label().alias("group"), _slot().alias("group_order"),
    )
    unnumbered = F.col("iteration") == 0
    placed = number_rows(
        rows, ["query"],
        [
            F.col("group_order"), F.floor(F.col("iteration") / bucket), F.when(unnumbered, 0).otherwise(1),
            F.when(unnumbered, F.floor(F.col("time_s") / width)).otherwise(0),
        ],
        ["iteration", "time_s"], "index",
    )
    return placed.withColumn("index", F.col("index") - 1).withColumn(
        "field", F.concat_ws(":", *(F.col(c).cast("string") for c in ("group_order", "iteration", "index")))
    )


# --- the processing phase -------------------------------------------------------------


def _processing_parts(query: Column, impl: Column) -> Column:
    """Names of the phases that make up the processing of a query."""
    both = F.array(F.lit("all_airlines_computation_s"), F.lit("top10_computation_s"))
    return (
        F.when(query == "Q1", F.array(F.lit("computation_s")))
        .when((query == "Q2") & (impl == "df"), both)
        .when((query == "Q2") & (impl == "rdd"), F.array(F.lit("computation_s")))
        .when(query == "Q3", F.array(F.lit("computation_percentiles_s")))
    )


def processing_times(rows: DataFrame, keys: Sequence[str] = tuple(GROUP), value: str = "mean_s") -> DataFrame:
    """One processing time per group, summed over its parts when all of them are there.

    ``rows`` holds one row per group and phase, statistics or (with ``iteration`` among
    the keys and ``time_s`` as value) single runs. One aggregation, no join of phases.
    """
    parts = _processing_parts(F.col("query"), F.col("impl"))
    place = F.array_position(parts, F.col("phase"))
    # One bit per part, so the parts seen are known without a distinct count.
    seen = F.bit_or(F.when(place == 1, F.lit(1)).otherwise(F.lit(2)))
    every = F.when(F.size(parts) == 1, F.lit(1)).otherwise(F.lit(3))
    return (
        rows.where((place > 0) & F.col("impl").isin(IMPLEMENTATIONS))
        .groupBy(*keys)
        .agg(F.sum(value).alias(value), seen.alias("_seen"))
        .where(F.col("_seen") == every)
        .select(*keys, F.lit("processing_s").alias("phase"), F.concat_ws("+", parts).alias("source_phase"), value)
    )


def processing_times_joined(rows: DataFrame, impl: str = "df") -> DataFrame:
    """Processing of the second query by joining its two phases; a check on the above."""
    chosen = rows.where((F.col("query") == "Q2") & (F.col("impl") == impl))
    first = chosen.where(F.col("phase") == "all_airlines_computation_s").select(*GROUP, F.col("mean_s").alias("a"))
    second = chosen.where(F.col("phase") == "top10_computation_s").select(*GROUP, F.col("mean_s").alias("b"))
    return first.join(second, GROUP).select(*GROUP, (F.col("a") + F.col("b")).alias("mean_s"))


# --- comparisons and report tables ----------------------------------------------------


def compare_implementations(stats: DataFrame, keys: Sequence[str] = ("worker_count", "query", "phase"),
                            phases: Sequence[str] | None = None) -> DataFrame:
    """Mean times side by side, their difference and ratio, and which is faster."""
    chosen = stats if phases is None else stats.where(F.col("phase").isin(list(phases)))
    wide = chosen.groupBy(*keys).pivot("impl", IMPLEMENTATIONS).agg(F.max("mean_s"))
    delta = F.col("rdd") - F.col("df")
    return wide.dropna(subset=IMPLEMENTATIONS).select(
        *keys,
        F.col("df").alias("df_mean_s"),
        F.col("rdd").alias("rdd_mean_s"),
        binary_round(delta, 3).alias("delta_s"),
        F.when(F.col("rdd") > 0, F.col("df") / F.col("rdd")).otherwise(F.lit(float("inf"))).alias("df_over_rdd"),
        F.when(delta > 0, "df").when(delta < 0, "rdd").otherwise("equal").alias("faster"),
    )


def total_time(log: DataFrame, phases: Sequence[str], keys: Sequence[str] = (*GROUP, "iteration")) -> DataFrame:
    """Sum of the named phases of each run."""
    return (
        log.where(F.col("phase").isin(list(phases)))
        .groupBy(*keys)
        .agg(binary_round(F.sum("time_s"), 3).alias("total_s"))
    )


def report_phases(report: DataFrame) -> DataFrame:
    """A phase report reduced to the phases of the direct comparison.

    Processing is the sum of both phases for the second query, the plain computation
    for the first, and for the third the plain computation if recorded, otherwise the
    percentiles. Statistics of summed phases add up column by column; n is the smaller.
    """
    values = STATS[1:]

    def of(phase: str, column: str) -> Column:
        return F.max(F.when(F.col("phase") == phase, F.col(column)))

    def there(phase: str) -> Column:
        return F.max(F.col("phase") == phase)

    direct = [p for p in DIRECT_PHASES if p != "processing_s"]
    first, second = "all_airlines_computation_s", "top10_computation_s"
    packed = {p: F.when(there(p), F.struct(*(of(p, c).alias(c) for c in STATS))) for p in
              [*direct, "computation_s", "computation_percentiles_s"]}
    summed = F.when(
        there(first) & there(second),
        F.struct(
            F.least(of(first, "n"), of(second, "n")).alias("n"),
            *((of(first, c) + of(second, c)).alias(c) for c in values),
        ),
    )
    grouped = report.groupBy("query").agg(
        *(value.alias(f"_{name}") for name, value in packed.items()), summed.alias("_summed")
    )
    processing = (
        F.when(F.col("query") == "Q2", F.coalesce("_summed", "_computation_s"))
        .when(F.col("query") == "Q3", F.coalesce("_computation_s", "_computation_percentiles_s"))
        .otherwise(F.col("_computation_s"))
    )
    options = [F.struct(F.lit(p).alias("phase"), F.col(f"_{p}").alias("s")) for p in direct]
    options.append(F.struct(F.lit("processing_s").alias("phase"), processing.alias("s")))
    return (
        grouped.select("query", F.inline(F.array(*options)))
        .where(F.col("s").isNotNull())
        .select("query", "phase", "s.*")
    )


def cold_vs_warm(cold: DataFrame, warm: DataFrame) -> DataFrame:
    """Cold-start and warm-session statistics under each other, per query and phase, as texts."""
    stacked = report_phases(cold).withColumn("mode", F.lit("cold start")).unionByName(
        report_phases(warm).withColumn("mode", F.lit("warmup"))
    )
    return stacked.where(F.col("query").isin(QUERIES)).select(
        "query",
        _lookup(DIRECT_PHASES, "phase", F.col("phase")).alias("phase"),
        "mode",
        *(number_text(c).alias(c.removesuffix("_s")) for c in STATS[1:]),
    )


def phase_summary(report: DataFrame) -> DataFrame:
    """A phase report as texts, with the ranks that order it."""
    return report.select(
        "query_order", "phase_order", "query",
        phase_label().alias("phase"),
        F.coalesce(F.col("n").cast("string"), F.lit("—")).alias("n"),
        *(number_text(c).alias(c.removesuffix("_s")) for c in STATS[1:]),
    )


def wide_lines(stats: DataFrame, phase: str) -> DataFrame:
    """Mean times of one phase per query and worker count, a column per implementation."""
    return (
        stats.where((F.col("phase") == phase) & F.col("query").isin(QUERIES))
        .groupBy("query", "worker_count")
        .pivot("impl", IMPLEMENTATIONS)
        .agg(F.max("mean_s"))
        .withColumn("display_phase", F.lit(phase))
    )


def incomplete_lines(lines: DataFrame) -> DataFrame:
    """Lines that miss an implementation."""
    return lines.where(F.col("df").isNull() | F.col("rdd").isNull())


def scaling_table(stats: DataFrame, phase: str, workers: Sequence[int]) -> DataFrame:
    """'mean ± std' per query and implementation, a column per worker count, a dash for gaps.

    Every query and implementation has a row, measured or not.
    """
    shown = stats.where(F.col("phase") == phase).withColumn("_text", mean_std_text("mean_s", "std_s"))
    wide = shown.groupBy("query", "impl").pivot("worker_count", list(workers)).agg(F.max("_text"))
    full = _grid(stats.sparkSession).join(wide, ["query", "impl"], "left")
    return full.select(
        "query",
        implementation_label().alias("impl"),
        *(F.coalesce(F.col(f"`{w}`"), F.lit("—")).alias(f"{w}W") for w in workers),
    )


def phase_breakdown(stats: DataFrame, worker_count: int) -> DataFrame:
    """Mean time of each stage per query and implementation at one worker count, as texts."""
    chosen = stats.where(F.col("worker_count") == worker_count)
    rows = chosen.where(F.col("phase") != "processing_s").select(*GROUP, "phase", "mean_s").unionByName(
        processing_times(chosen).select(*GROUP, "phase", "mean_s")
    )
    wide = rows.groupBy("query", "impl").pivot("phase", BREAKDOWN_PHASES).agg(F.max("mean_s"))
    full = _grid(stats.sparkSession).join(wide, ["query", "impl"], "left")
    return full.select(
        "query",
        implementation_label().alias("impl"),
        *(number_text(p).alias(p.removesuffix("_s")) for p in BREAKDOWN_PHASES),
    )


def _grid(spark: SparkSession) -> DataFrame:
    """Every query with every implementation: six rows."""
    one = spark.range(1)
    queries = F.explode(F.array(*map(F.lit, QUERIES)))
    impls = F.explode(F.array(*map(F.lit, IMPLEMENTATIONS)))
    return one.select(queries.alias("query")).select("query", impls.alias("impl"))


def worker_counts(log: DataFrame) -> DataFrame:
    return log.select("worker_count").where(F.col("worker_count").isNotNull()).distinct()


def missing_combinations(log: DataFrame, phases: Sequence[str], few: int = FEW) -> DataFrame:
    """Combinations of workers, query, implementation and phase without observations, or few.

    Facts are counted once; the expected combinations are the observed worker counts
    with every query, implementation and phase.
    """
    wanted = log.where(
        F.col("phase").isin(list(phases))
        & F.col("query").isin(QUERIES)
        & F.col("impl").isin(IMPLEMENTATIONS)
        & F.col("worker_count").isNotNull()
    )
    # The counts of one worker count fit in a map: at most one entry per combination.
    spot = F.concat_ws("|", "query", "impl", "phase")
    seen = (
        wanted.groupBy(*GROUP, "phase")
        .agg(F.count("time_s").alias("n"))
        .groupBy("worker_count")
        .agg(F.map_from_entries(F.collect_list(F.struct(spot, "n"))).alias("_seen"))
    )
    expected = (
        seen.withColumn("query", F.explode(F.array(*map(F.lit, QUERIES))))
        .withColumn("impl", F.explode(F.array(*map(F.lit, IMPLEMENTATIONS))))
        .withColumn("phase", F.explode(F.array(*map(F.lit, phases))))
        .withColumn("n", F.coalesce(F.col("_seen")[spot], F.lit(0)))
    )
    return expected.where(F.col("n") < few).select(
        *GROUP, "phase", "n", F.when(F.col("n") == 0, "missing").otherwise("few").alias("finding")
    )
