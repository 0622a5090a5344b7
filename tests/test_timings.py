import statistics

import pytest

from delayscope.operators import timings as t
from tests.helpers import by, dicts

LOG = "worker_count int, query string, impl string, phase string, iteration int, time_s double"


def log(spark, rows):
    return spark.createDataFrame(rows, LOG)


def stats(spark, rows):
    ddl = "worker_count int, query string, impl string, phase string, mean_s double, std_s double"
    return spark.createDataFrame(rows, ddl)


def test_phase_stats_match_the_statistics_module(spark):
    times = [0.311, 0.42, 0.42, 1.5, 9.007]
    df = log(spark, [(1, "Q1", "df", "output_s", i, v) for i, v in enumerate(times)] + [(1, "Q1", "df", "output_s", 9, None)])
    (row,) = dicts(t.phase_stats(df))
    want = [5, statistics.mean(times), statistics.stdev(times), statistics.median(times), min(times), max(times)]
    assert [row[c] for c in t.STATS] == [round(v, 3) for v in want]


def test_single_observation(spark):
    df = log(spark, [(1, "Q1", "df", "output_s", 1, 2.5)])
    assert dicts(t.phase_stats(df))[0]["std_s"] == 0.0
    assert dicts(t.phase_stats(df, single_std=None))[0]["std_s"] is None
    assert dicts(t.phase_stats(df))[0]["median_s"] == 2.5


def test_normalise_iterations(spark):
    df = spark.createDataFrame(
        [(" 1 ", "q1", "DF ", "p", "", "7", "2.5"), ("x", "q1", "df", "p", "1", "", "1"), ("2", "q1", "df", "p", "", "", "bad")],
        "worker_count string, query string, impl string, phase string, iteration string, run string, time_s string",
    )
    assert dicts(t.normalise_iterations(df)) == [
        {"worker_count": 1, "query": "Q1", "impl": "df", "phase": "p", "iteration": 7, "time_s": 2.5}
    ]
    with pytest.raises(ValueError):
        t.normalise_iterations(df.drop("phase"))


def test_box_stats_interpolate(spark):
    df = log(spark, [(2, "Q1", "rdd", "end_to_end_s", i, v) for i, v in enumerate([1.0, 2.0, 4.0, 8.0])])
    (row,) = dicts(t.box_stats(df))
    assert (row["q1_s"], row["median_s"], row["q3_s"]) == (1.75, 3.0, 5.0)
    assert (row["group"], row["group_order"], row["time"].minute) == ("2W rdd", 21, 21)


def test_box_rows_are_numbered_per_query(spark):
    df = log(spark, [(w, "Q1", impl, "end_to_end_s", i, 1.0) for w in (2, 1) for impl in ("rdd", "df") for i in (2, 1)])
    fields = [r["field"] for r in sorted(dicts(t.box_rows(df)), key=lambda r: r["index"])]
    assert fields == ["10:1:0", "10:2:1", "11:1:2", "11:2:3", "20:1:4", "20:2:5", "21:1:6", "21:2:7"]


def test_warmup_is_dropped_and_runs_renumbered(spark):
    df = log(spark, [(1, "Q1", "df", "p", i, 1.0) for i in range(0, 60, 3)])
    found = t.drop_warmup(df.withColumnRenamed("iteration", "run_id"), 5, bucket=10)
    assert {r["run_id"]: r["iteration"] for r in dicts(found)} == {3 * (i + 5): i + 1 for i in range(15)}


def test_warmup_counts_runs_not_rows(spark):
    rows = [(w, "Q1", "df", p, i, 1.0) for w in (1, 2) for p in ("a", "b") for i in range(1, 9)]
    df = log(spark, rows).withColumnRenamed("iteration", "run_id")
    for numbered in (False, True):
        found = dicts(t.drop_warmup(df, 5, numbered=numbered))
        assert len(found) == 12 and {r["iteration"] for r in found} == {1, 2, 3}


def test_processing_needs_all_its_parts(spark):
    df = stats(
        spark,
        [
            (1, "Q2", "df", "all_airlines_computation_s", 1.0, 0.0), (1, "Q2", "df", "top10_computation_s", 0.5, 0.0),
            (2, "Q2", "df", "all_airlines_computation_s", 1.0, 0.0), (1, "Q2", "rdd", "computation_s", 3.0, 0.0),
            (1, "Q3", "df", "computation_percentiles_s", 4.0, 0.0), (1, "Q1", "df", "loading_s", 9.0, 0.0),
        ],
    )
    found = {(r["worker_count"], r["query"], r["impl"]): r["mean_s"] for r in dicts(t.processing_times(df))}
    assert found == {(1, "Q2", "df"): 1.5, (1, "Q2", "rdd"): 3.0, (1, "Q3", "df"): 4.0}
    assert [r["mean_s"] for r in dicts(t.processing_times_joined(df))] == [1.5]


def test_comparison(spark):
    df = stats(spark, [(1, "Q1", "df", "p", 2.0, 0.0), (1, "Q1", "rdd", "p", 8.0, 0.0), (1, "Q2", "df", "p", 1.0, 0.0)])
    (row,) = dicts(t.compare_implementations(df))
    assert (row["delta_s"], row["df_over_rdd"], row["faster"]) == (6.0, 0.25, "df")


def report(spark, rows):
    ddl = "query string, phase string, n int, mean_s double, std_s double, median_s double, min_s double, max_s double"
    return spark.createDataFrame([(q, p, n, *[v] * 5) for q, p, n, v in rows], ddl)


def test_report_phases(spark):
    df = report(
        spark,
        [
            ("Q1", "computation_s", 15, 1.0), ("Q1", "output_s", 15, 9.0), ("Q1", "loading_s", 15, 0.5),
            ("Q2", "all_airlines_computation_s", 15, 2.0), ("Q2", "top10_computation_s", 10, 1.0),
            ("Q3", "computation_percentiles_s", 15, 7.0),
        ],
    )
    found = {(r["query"], r["phase"]): (r["n"], r["mean_s"]) for r in dicts(t.report_phases(df))}
    assert found == {
        ("Q1", "processing_s"): (15, 1.0), ("Q1", "loading_s"): (15, 0.5), ("Q2", "processing_s"): (10, 3.0),
        ("Q3", "processing_s"): (15, 7.0),
    }
    fallback = report(spark, [("Q2", "computation_s", 3, 4.0), ("Q2", "top10_computation_s", 3, 1.0)])
    assert [(r["phase"], r["mean_s"]) for r in dicts(t.report_phases(fallback))] == [("processing_s", 4.0)]
    shown = dicts(t.cold_vs_warm(df, fallback))
    assert {r["mode"] for r in shown} == {"cold start", "warmup"} and shown[0]["mean"].count(".") == 1


def test_tables_show_gaps(spark):
    df = stats(spark, [(1, "Q1", "df", "end_to_end_s", 2.125, 0.5), (2, "Q1", "df", "end_to_end_s", 1.0, None)])
    found = by(t.scaling_table(df, "end_to_end_s", [1, 2]), "query", "impl")
    assert len(found) == 6
    assert (found["Q1", "DataFrame"]["1W"], found["Q1", "DataFrame"]["2W"]) == ("2.12 ± 0.50", "1.00")
    assert found["Q3", "RDD"]["1W"] == "—"
    breakdown = by(t.phase_breakdown(df, 1), "query", "impl")
    assert breakdown["Q1", "DataFrame"]["end_to_end"] == "2.12" and breakdown["Q1", "DataFrame"]["output"] == "—"


def test_phase_order(spark):
    df = t.normalise_phase_report(report(spark, [("q2", " loading_s", 1, 1.0), ("other", "new_s", 1, 1.0)]))
    found = by(t.phase_summary(df), "query")
    assert (found[("Q2",)]["query_order"], found[("Q2",)]["phase_order"], found[("Q2",)]["phase"]) == (2, 1, "Loading")
    assert (found[("OTHER",)]["query_order"], found[("OTHER",)]["phase_order"], found[("OTHER",)]["phase"]) == (999, 999, "new_s")


def test_missing_and_few(spark):
    rows = [(1, q, i, "end_to_end_s", n, 1.0) for q in t.QUERIES for i in t.IMPLEMENTATIONS for n in range(5)]
    rows = [r for r in rows if not (r[1] == "Q3" and r[2] == "rdd") and not (r[1] == "Q2" and r[2] == "df" and r[4] > 1)]
    found = {(r["query"], r["impl"]): (r["n"], r["finding"]) for r in dicts(t.missing_combinations(log(spark, rows), ["end_to_end_s"]))}
    assert found == {("Q3", "rdd"): (0, "missing"), ("Q2", "df"): (2, "few")}


def test_lines(spark):
    df = stats(spark, [(1, "Q1", "df", "p", 2.0, 0.0), (1, "Q1", "rdd", "p", 3.0, 0.0), (2, "Q1", "df", "p", 1.0, 0.0)])
    lines = t.wide_lines(df, "p")
    assert {(r["worker_count"], r["df"], r["rdd"]) for r in dicts(lines)} == {(1, 2.0, 3.0), (2, 1.0, None)}
    assert [r["worker_count"] for r in dicts(t.incomplete_lines(lines))] == [2]


def test_totals(spark):
    df = log(spark, [(1, "Q1", "df", p, 1, v) for p, v in (("loading_s", 0.1), ("filtering_s", 0.2), ("output_s", 5.0))])
    assert dicts(t.total_time(df, ["loading_s", "filtering_s"]))[0]["total_s"] == 0.3


def test_reports_are_stacked_from_files(spark, tmp_path):
    header = "worker_count,query,impl,phase,iteration,time_s"
    for worker in (1, 2):
        (tmp_path / f"raw_{worker}.csv").write_text(f"{header}\n{worker},q1,DF,output_s,1,2.5\n")
    (tmp_path / "raw_3.csv").write_text(header + "\n")
    (tmp_path / "other.csv").write_text("x\n1\n")
    rows = t.normalise_iterations(t.read_reports(spark, f"{tmp_path}/raw_*.csv"))
    assert sorted((r["worker_count"], r["query"], r["impl"], r["time_s"]) for r in dicts(rows)) == [
        (1, "Q1", "df", 2.5), (2, "Q1", "df", 2.5),
    ]


def test_stacked_reports_fill_missing_columns(spark):
    one = log(spark, [(1, "Q1", "df", "p", 1, 1.0)])
    stacked = t.stack_reports([one, one.drop("iteration")])
    assert sorted(r["iteration"] or 0 for r in dicts(stacked)) == [0, 1]


def test_absent_reports_add_no_rows(spark, tmp_path):
    found = t.read_reports(spark, f"{tmp_path}/none/*.csv")
    assert found.count() == 0 and t.normalise_stats(found).count() == 0
