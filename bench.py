"""Headline timings as one JSON line.

Two parts. ``queries`` are registered queries over the given tables, each materialised
into the no-op sink. ``phases`` repeat the published protocol on processed Parquet: the
three analyses with loading, computation and CSV output timed apart, reported with the
statistics columns of the published reports. The published numbers are for about 2.2
million flights, so the flights of the given tables are repeated to about that many.
Every iteration starts without cached data.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from delayscope import build_session  # noqa: E402
from delayscope.operators import carriers, hourly, monthly  # noqa: E402
from delayscope.plans import jobs  # noqa: E402
from delayscope.sinks import files as sinks  # noqa: E402
from delayscope.sources import files as sources  # noqa: E402
from verification import inputs  # noqa: E402
from verification.registry import REGISTRY  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
QUERY_WARMUP, QUERY_RUNS = 1, 2
PHASE_WARMUP, PHASE_RUNS = 5, 15
PUBLISHED_ROWS = 2_200_000

HEADLINE = [
    "clean_flights", "q1_monthly_stats", "q2_carrier_stats", "q2_top10", "q3_hourly_percentiles",
    "q3_hourly_percentiles_approx", "q3_exact_interp", "q3_sketch", "q3_minmax", "dq_profile",
    "dq_duplicates", "dq_examples", "dq_row_counts", "dq_missing_causes", "night_flights", "result_diff",
    "feed_q1_series", "feed_q3_series", "feed_cause_share", "bench_stats", "bench_boxstats",
    "bench_processing", "bench_warmup_drop",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def query_times(spark) -> dict[str, float]:
    found = {}
    for name in HEADLINE:
        times = []
        for run in range(QUERY_WARMUP + QUERY_RUNS):
            spark.catalog.clearCache()
            seconds = timed(lambda name=name: noop(REGISTRY[name](spark, SF_DIR)))
            if run >= QUERY_WARMUP:
                times.append(seconds)
        found[name] = round(statistics.median(times), 4)
    return found


def phase_rows(spark, facts: str, out: str) -> list[dict]:
    """Loading is a real read of the needed columns, not a row count from file footers."""
    columns = {
        "Q1": ["MONTH", "OP_UNIQUE_CARRIER", "DEP_DELAY", "ARR_DELAY", "CANCELLED"],
        "Q2": None,
        "Q3": ["OP_UNIQUE_CARRIER", "CRS_DEP_TIME", "DEP_DELAY", "CANCELLED"],
    }

    def load(query):
        return sources.read_processed(spark, facts, columns[query])

    parts = {
        "Q1": {"computation_s": lambda: noop(monthly.monthly_stats(load("Q1")))},
        "Q2": {
            "all_airlines_computation_s": lambda: noop(carriers.carrier_stats(load("Q2"))),
            "top10_computation_s": lambda: noop(carriers.top_carriers(carriers.carrier_stats(load("Q2")))),
        },
        "Q3": {
            "computation_percentiles_s": lambda: noop(hourly.hourly_percentiles(load("Q3"))),
            "computation_minmax_s": lambda: noop(hourly.delay_extremes(load("Q3"))),
        },
    }
    whole = {
        "Q1": lambda: jobs.monthly_job(spark, facts, out),
        "Q2": lambda: jobs.carriers_job(spark, facts, out),
        "Q3": lambda: jobs.hourly_job(spark, facts, out),
    }
    rows = []
    for query, computations in parts.items():
        actions = {"loading_s": lambda query=query: noop(load(query)), **computations, "end_to_end_s": whole[query]}
        for phase, action in actions.items():
            times = []
            for run in range(PHASE_WARMUP + PHASE_RUNS):
                spark.catalog.clearCache()
                seconds = timed(action)
                if run >= PHASE_WARMUP:
                    times.append(seconds)
            rows.append(
                {
                    "query": query, "phase": phase, "n": len(times),
                    "mean_s": round(statistics.mean(times), 3), "std_s": round(statistics.stdev(times), 3),
                    "median_s": round(statistics.median(times), 3),
                    "min_s": round(min(times), 3), "max_s": round(max(times), 3),
                }
            )
    return rows


def main() -> None:
    spark = build_session(
        "bench", f"local[{CPUS}]",
        {"spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="bench-")
    flights = inputs.flights(spark, SF_DIR)
    copies = max(1, round(PUBLISHED_ROWS / flights.count()))
    repeated = flights.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("copy")
    rows = sinks.write_processed(repeated.repartition(int(CPUS)), f"{scratch}/facts")
    queries = query_times(spark)
    phases = phase_rows(spark, f"{scratch}/facts", f"{scratch}/out")
    ends = {r["query"]: r["mean_s"] for r in phases if r["phase"] == "end_to_end_s"}
    print(
        json.dumps(
            {
                "metric": "sum of median seconds of the headline queries",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "phase_fact_rows": rows,
                "end_to_end_rows_per_s": {q: round(rows / s) for q, s in ends.items()},
                "phases": phases,
            }
        )
    )


if __name__ == "__main__":
    main()
