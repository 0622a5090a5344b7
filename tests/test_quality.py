from delayscope.operators import quality
from tests.helpers import by, causes, dicts, raw
from verification import inputs


def sample(spark):
    return raw(
        spark,
        [
            {"CANCELLED": 1.0, "DIVERTED": 1.0, "CRS_DEP_TIME": None},
            {"CANCELLED": 2.0, "DIVERTED": None, "CRS_DEP_TIME": 2401},
            {"ARR_DELAY": 20.0, **causes(10.0, 10.0, 0.0, 0.0, 1e-7), "CRS_DEP_TIME": 1267},
            {"ARR_DELAY": 20.0, **causes(10.0, 5.0, 0.0, 0.0, 0.0), "CRS_DEP_TIME": -50},
            {"ARR_DELAY": 16.0, **causes(10.0, 9.0, 0.0, 0.0, 0.0)},
            {"ARR_DELAY": 30.0, **causes(10.0, None, 0.0, 0.0, -1.0)},
            {"ARR_DELAY": 15.0, "DEP_DELAY": -4.0},
            {"ARR_DELAY": 3.0, "OP_UNIQUE_CARRIER": None, "MONTH": 7},
        ],
    )


def test_status_and_clock(spark):
    (status,) = dicts(quality.status_report(sample(spark)))
    assert [status[f"cancelled_{k}"] for k in ("0", "1", "null", "other")] == [6, 1, 0, 1]
    assert [status[f"diverted_{k}"] for k in ("0", "1", "null", "other")] == [6, 1, 1, 0]
    assert status["cancelled_and_diverted"] == 1
    (clock,) = dicts(quality.clock_report(sample(spark)))
    assert [clock[f"crs_{k}"] for k in ("null", "negative", "above_2400", "bad_minutes", "invalid")] == [1, 1, 1, 1, 4]


def test_delays(spark):
    (found,) = dicts(quality.delay_report(sample(spark)))
    assert (found["dep_delay_null_eligible"], found["arr_delay_null_eligible"]) == (5, 0)
    assert (found["arr_delay_min"], found["arr_delay_max"], found["dep_delay_negative"]) == (3.0, 30.0, 1)


def test_bands_always_appear(spark):
    found = by(quality.delay_bands(sample(spark)), "delay", "band")
    assert len(found) == 6
    late = found["ARR_DELAY", "ge_15"]
    assert (late["total"], late["all_causes_null"], late["any_cause_null"]) == (5, 1, 2)
    assert late["all_causes_null_pct"] == 20.0
    assert found["DEP_DELAY", "ge_15"]["total"] == 0 and found["DEP_DELAY", "ge_15"]["any_cause_null_pct"] == 0.0


def test_reconciliation_tolerates_a_millionth(spark):
    found = by(quality.cause_reconcile(sample(spark)), "threshold")
    late = found[("ge_15",)]
    assert [late[c] for c in ("flights", "comparable", "equal", "differ", "less", "greater")] == [5, 3, 1, 2, 1, 1]
    assert (late["mean_abs_diff"], late["max_abs_diff"]) == (4.0, 5.0)
    assert found[("gt_0",)]["all_causes_null"] == 2


def test_cause_nulls(spark):
    found = by(quality.cause_nulls(sample(spark)), "cause")
    assert found[("WEATHER_DELAY",)]["nulls"] == 5
    assert found[("LATE_AIRCRAFT_DELAY",)]["negatives"] == 1


def test_profile_holds_every_report(spark, small):
    for data in (sample(spark), inputs.raw_flights(spark, small)):
        profile = {r["metric"]: r["value"] for r in dicts(quality.quality_profile(data))}
        for report in (quality.status_report, quality.delay_report, quality.clock_report):
            (direct,) = dicts(report(data))
            for metric, value in direct.items():
                assert profile[metric] == value, metric
        for row in dicts(quality.cause_reconcile(data)):
            for part in ("flights", "all_causes_null", "comparable", "equal", "differ", "less", "greater"):
                assert profile[f"{row['threshold']}_{part}"] == row[part]
        for row in dicts(quality.delay_bands(data)):
            assert profile[f"{row['delay'].lower()}_{row['band']}_total"] == row["total"]
            assert profile[f"{row['delay'].lower()}_{row['band']}_any_null"] == row["any_cause_null"]


def test_profile_of_nothing(spark):
    profile = {r["metric"]: r["value"] for r in dicts(quality.quality_profile(sample(spark).limit(0)))}
    assert profile["rows"] == 0 and profile["dep_delay_min"] is None


def test_row_counts(spark):
    found = by(quality.row_counts(sample(spark)), "dimension", "value")
    assert found["total", "all"]["rows"] == 8
    assert found["carrier", "NULL"]["rows"] == 1
    assert found["month", "7"]["unexpected"] and not found["month", "1"]["unexpected"]


def test_duplicates(spark):
    same = {"OP_CARRIER_FL_NUM": 1, "CRS_DEP_TIME": None}
    df = raw(spark, [same, same, same, {"OP_CARRIER_FL_NUM": 2}, {"OP_CARRIER_FL_NUM": 3}, {"OP_CARRIER_FL_NUM": 3}])
    assert dicts(quality.duplicate_audit(df)) == [{"duplicate_groups": 2, "rows_in_groups": 5}]
    assert dicts(quality.duplicate_audit(df.where("OP_CARRIER_FL_NUM = 2"))) == [
        {"duplicate_groups": 0, "rows_in_groups": 0}
    ]


def test_examples_are_the_first_in_order(spark):
    rows = [{"DAY_OF_MONTH": d, "OP_CARRIER_FL_NUM": d, "CANCELLED": 1.0, "DIVERTED": 1.0} for d in (9, 3, 7, 1, 5, 2, 8)]
    rows.append({"DAY_OF_MONTH": None, "OP_CARRIER_FL_NUM": 0, "CANCELLED": 1.0, "DIVERTED": 1.0})
    rows += [{"ARR_DELAY": 20.0, **causes(10.0, 5.0, 0.0, 0.0, 0.0)}]
    found = dicts(quality.examples(raw(spark, rows)))
    days = {r["position"]: r["DAY_OF_MONTH"] for r in found if r["check"] == "cancelled_and_diverted"}
    assert days == {1: None, 2: 1, 3: 2, 4: 3, 5: 5}
    (off,) = [r for r in found if r["check"] == "cause_sum_differs"]
    assert (off["total_cause_delay"], off["total_minus_arr_delay"]) == (15.0, -5.0)


def test_missing_causes_per_file_and_total(spark):
    found = by(quality.missing_causes(sample(spark), "MONTH"), "MONTH")
    assert found[(7,)]["is_total"] == 0 and found[(None,)]["is_total"] == 1
    assert found[(7,)]["all_causes_null"] == 1 and found[(7,)]["all_causes_null_pct"] == 100.0
    assert (found[(None,)]["positive_delay_rows"], found[(None,)]["all_causes_null"]) == (6, 2)
