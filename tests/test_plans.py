"""The physical plans the operators are meant to get, over Parquet written from the views."""

import re

import pytest

from delayscope.operators import carriers, hourly, monthly, night, percentiles, quality, timings
from delayscope.schema import CAUSES
from delayscope.sinks import files as sinks
from delayscope.sources import files as sources
from verification import inputs
from verification.registry import REGISTRY


@pytest.fixture(scope="module")
def facts(spark, small, tmp_path_factory):
    root = tmp_path_factory.mktemp("facts")
    df = inputs.flights(spark, small)
    sinks.write_processed(df, f"{root}/plain")
    sinks.write_processed(df, f"{root}/by_carrier", partition_by="OP_UNIQUE_CARRIER")
    return root


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def shuffles(df):
    return len(re.findall(r"^\(\d+\) Exchange", plan(df), re.M))


def read_columns(text):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*?)>", text)]


def test_monthly_reads_five_columns_and_shuffles_once(spark, facts):
    df = monthly.monthly_stats(sources.read_processed(spark, f"{facts}/plain"))
    text = plan(df)
    assert read_columns(text) == [{"MONTH", "OP_UNIQUE_CARRIER", "DEP_DELAY", "ARR_DELAY", "CANCELLED"}]
    assert "In(OP_UNIQUE_CARRIER, [AA,DL])" in text
    assert shuffles(df) == 1 and "partial_avg" in text


def test_carrier_filters_reach_the_scan(spark, facts):
    text = plan(carriers.carrier_stats(sources.read_processed(spark, f"{facts}/plain")))
    for part in ("EqualTo(CANCELLED,0)", "EqualTo(DIVERTED,0)", "IsNotNull(ARR_DELAY)"):
        assert part in text
    assert "YEAR" not in read_columns(text)[0]


def test_ranking_is_a_top_k(spark, facts):
    df = carriers.top_carriers(carriers.carrier_stats(sources.read_processed(spark, f"{facts}/plain")))
    assert "TakeOrderedAndProject" in plan(df) and "rangepartitioning" not in plan(df)


def test_hour_range_is_pushed_as_clock_range(spark, facts):
    text = plan(hourly.hourly_percentiles(sources.read_processed(spark, f"{facts}/plain")))
    assert "GreaterThanOrEqual(CRS_DEP_TIME,0)" in text and "LessThanOrEqual(CRS_DEP_TIME,2399)" in text
    assert read_columns(text) == [{"OP_UNIQUE_CARRIER", "CRS_DEP_TIME", "DEP_DELAY", "CANCELLED"}]


def test_carrier_partitions_are_pruned(spark, facts):
    text = plan(monthly.monthly_stats(sources.read_processed(spark, f"{facts}/by_carrier")))
    (filters,) = set(re.findall(r"PartitionFilters: \[(.*)\]", text))
    assert "OP_UNIQUE_CARRIER" in filters and "AA" in filters


def test_values_are_counted_before_they_meet(spark, facts):
    departures = hourly.hourly_departures(sources.read_processed(spark, f"{facts}/plain"))
    text = plan(hourly.delay_counts(departures))
    assert re.search(r"Exchange\n.*\n?Arguments: hashpartitioning\(airline#\d+, hour#\d+, DEP_DELAY", text)
    assert "partial_count" in text


def test_profile_is_one_pass(spark, facts):
    raw = spark.read.parquet(f"{facts}/plain")
    text = plan(quality.quality_profile(raw))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 1
    assert set(CAUSES) <= read_columns(text)[0] and "YEAR" not in read_columns(text)[0]


def test_row_counts_expand_counts_not_rows(spark, facts):
    text = plan(quality.row_counts(spark.read.parquet(f"{facts}/plain")))
    tree = text[: text.index("(1) Scan parquet")]
    assert tree.index("Expand") < tree.rindex("Exchange")
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 1


def test_missing_combinations_scan_once(spark, small):
    text = plan(timings.missing_combinations(inputs.tlog(spark, small), ["end_to_end_s"]))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, re.M)) == 1 and "Join" not in text


def test_night_flights_cut_each_task(spark, facts):
    assert "WindowGroupLimit" in plan(night.night_flights(sources.read_processed(spark, f"{facts}/plain")))


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - {"ingest_filter"}))
def test_no_python_and_no_cross_join_in_any_query(spark, small, name):
    text = plan(REGISTRY[name](spark, small))
    for word in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert word not in text


def test_percentile_names():
    assert [percentiles.percentile_name(p) for p in (0.25, 0.5, 0.9, 0.999, 1.0)] == ["p25", "p50", "p90", "p99_9", "p100"]
