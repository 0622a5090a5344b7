import statistics

from delayscope.operators import carriers, hourly, monthly, night
from delayscope.operators.cleaning import clean_flights
from delayscope.schema import MONTHLY_KEYS, MONTHLY_MEASURES, PROCESSED_COLUMNS
from tests.helpers import by, causes, dicts, flights, raw
from verification import inputs


def test_cleaning(spark):
    source = raw(
        spark,
        [
            {"OP_UNIQUE_CARRIER": None},
            {"DEP_DELAY": -5.0, "CANCELLED": 1.0, **causes(1.0, None, None, None, None)},
        ],
    )
    cleaned = clean_flights(source)
    assert cleaned.columns == PROCESSED_COLUMNS
    (row,) = dicts(cleaned)
    assert (row["CANCELLED"], row["DEP_DELAY"], row["ARR_DELAY"]) == (1, -5.0, None)
    assert (row["CARRIER_DELAY"], row["LATE_AIRCRAFT_DELAY"]) == (1.0, 0.0)


def test_monthly_counts_cancelled_but_does_not_measure_them(spark):
    df = flights(
        spark,
        [
            {"DEP_DELAY": 30.0, "ARR_DELAY": None, "CANCELLED": 1},
            {"DEP_DELAY": 10.0, "ARR_DELAY": 4.0},
            {"DEP_DELAY": None, "ARR_DELAY": 2.0},
            {"OP_UNIQUE_CARRIER": "DL", "MONTH": 2, "DEP_DELAY": 9.0, "CANCELLED": 1},
            {"OP_UNIQUE_CARRIER": "ZZ"},
        ],
    )
    found = by(monthly.monthly_stats(df), "month", "airline")
    assert set(found) == {(1, "AA"), (2, "DL")}
    aa, dl = found[1, "AA"], found[2, "DL"]
    assert (aa["total_flights"], aa["cancelled_flights"], aa["non_cancelled_flights"]) == (3, 1, 2)
    assert (aa["dep_delay_mean"], aa["dep_delay_max"], aa["arr_delay_mean"]) == (10.0, 10.0, 3.0)
    assert aa["cancellation_rate"] == 33.3333
    assert dl["cancellation_rate"] == 100.0 and dl["dep_delay_mean"] is None
    joined = by(monthly.monthly_stats_joined(df), "month", "airline")
    assert set(joined) == {(1, "AA")}


def test_monthly_formulations_agree(spark, small):
    df = inputs.flights(spark, small)
    single = monthly.monthly_stats(df, None).select(*MONTHLY_KEYS, *MONTHLY_MEASURES)
    joined = monthly.monthly_stats_joined(df, None)
    assert single.exceptAll(joined).isEmpty() and joined.exceptAll(single).isEmpty()


def test_carrier_stats_leave_out_diverted_and_unknown(spark):
    df = flights(
        spark,
        [
            {"ARR_DELAY": 20.0, **causes(20.0, 0.0, 0.0, 0.0, 0.0)},
            {"ARR_DELAY": 10.0},
            {"ARR_DELAY": None},
            {"ARR_DELAY": 99.0, "DIVERTED": 1},
            {"ARR_DELAY": 99.0, "CANCELLED": 1},
        ],
    )
    (row,) = dicts(carriers.carrier_stats(df))
    assert (row["num_flights"], row["arrdelay_mean"], row["carrier_delay_mean"]) == (2, 15.0, 10.0)


def test_ranking_threshold_and_ties(spark):
    df = spark.createDataFrame(
        [("B", 500, 3.0), ("A", 501, 3.0), ("C", 499, 9.0), ("D", 900, 5.0)],
        "carrier string, num_flights long, arrdelay_mean double",
    )
    assert [r["carrier"] for r in carriers.top_carriers(df, k=3).collect()] == ["D", "A", "B"]
    assert [r["carrier"] for r in carriers.top_carriers(df, k=1).collect()] == ["D"]


def test_hours_kept(spark):
    clocks = [2400, 2359, 0, 59, -50, None, 1267]
    df = flights(spark, [{"OP_UNIQUE_CARRIER": "UA", "CRS_DEP_TIME": c, "DEP_DELAY": 1.0} for c in clocks])
    found = by(hourly.hourly_percentiles(df), "airline", "hour")
    assert {key: row["num_flights"] for key, row in found.items()} == {("UA", 0): 2, ("UA", 12): 1, ("UA", 23): 1}
    assert all(found["UA", 23][p] == 1.0 for p in ("p25", "p50", "p75", "p90"))


def test_percentile_forms(spark):
    delays = [float(v) for v in (3, 1, 4, 1, 5, 9, 2, 6, 5, 3)]
    df = flights(spark, [{"DEP_DELAY": v} for v in delays])
    (observed,) = dicts(hourly.hourly_percentiles(df))
    ordered = sorted(delays)
    # Smallest value whose rank reaches p * n: ranks 3, 5, 8 and 9 of ten.
    assert [observed[p] for p in ("p25", "p50", "p75", "p90")] == [ordered[i - 1] for i in (3, 5, 8, 9)]
    (between,) = dicts(hourly.hourly_percentiles_interpolated(df))
    quartiles = statistics.quantiles(delays, n=4, method="inclusive")
    assert [between[p] for p in ("p25", "p50", "p75")] == quartiles
    (approx,) = dicts(hourly.hourly_percentiles_approx(df))
    assert [approx[p] for p in ("p25", "p50", "p75", "p90")] == [observed[p] for p in ("p25", "p50", "p75", "p90")]


def test_extremes_from_rows_and_counts(spark, small):
    df = inputs.flights(spark, small)
    direct = hourly.delay_extremes(df)
    counted = hourly.extremes_from_counts(hourly.delay_counts(hourly.hourly_departures(df)))
    assert direct.exceptAll(counted).isEmpty() and counted.exceptAll(direct).isEmpty()


def test_sketches_roll_up(spark, small):
    df = inputs.flights(spark, small)
    monthly_sketches = hourly.delay_sketches(df, by=["MONTH"])
    rolled = hourly.read_sketches(hourly.merge_sketches(monthly_sketches))
    exact = by(hourly.hourly_percentiles(df), "airline", "hour")
    assert {k: r["num_flights"] for k, r in by(rolled, "airline", "hour").items()} == {
        k: r["num_flights"] for k, r in exact.items()
    }
    checked = dicts(hourly.sketch_rank_check(df, rolled))
    assert len(checked) == len(exact)
    assert all(row[f"{p}_ok"] for row in checked for p in ("p25", "p50", "p75", "p90"))


def test_rank_check_sees_a_wrong_estimate(spark, small):
    df = inputs.flights(spark, small)
    wrong = hourly.hourly_percentiles(df).withColumnRenamed("p50", "x").withColumnRenamed("p90", "p50")
    wrong = wrong.withColumnRenamed("x", "p90")
    assert not any(row["p50_ok"] for row in dicts(hourly.sketch_rank_check(df, wrong)))


def test_night_variants(spark):
    rows = [{"OP_UNIQUE_CARRIER": "WN", "CRS_DEP_TIME": c, "DEP_DELAY": d, "CANCELLED": x} for c, d, x in
            [(459, 1.0, 0), (500, 1.0, 0), (10, None, 1), (20, None, 0), (-50, 1.0, 0)]]
    found = night.night_flights(flights(spark, rows), k=2)
    counts = {}
    for row in dicts(found):
        counts.setdefault(row["variant"], []).append(row["CRS_DEP_TIME"])
    assert {k: sorted(v) for k, v in counts.items()} == {"all": [10, 20], "not_cancelled": [20, 459], "with_delay": [459]}


def test_hourly_status_keeps_every_hour(spark):
    rows = [{"OP_UNIQUE_CARRIER": "WN", "CRS_DEP_TIME": c, "DEP_DELAY": None, "CANCELLED": 1} for c in (2400, None, 5)]
    found = by(night.hourly_status(flights(spark, rows)), "hour")
    assert set(found) == {(24,), (None,), (0,)}
    assert all(r["cancelled"] == 1 and r["dep_delay_null"] == 1 for r in found.values())
