import pytest
from pyspark.errors import PySparkException

from delayscope.operators import feeds
from delayscope.schema import CAUSE_MEANS, MONTHLY_MEASURES
from tests.helpers import by, dicts


def monthly(spark, rows):
    ddl = "month int, airline string, " + ", ".join(f"{m} double" for m in MONTHLY_MEASURES)
    return spark.createDataFrame([(m, a, *[v] * len(MONTHLY_MEASURES)) for m, a, v in rows], ddl)


def ranked(spark, *cause_rows):
    ddl = "rank int, carrier string, num_flights long, arrdelay_mean double, " + ", ".join(f"{c} double" for c in CAUSE_MEANS)
    return spark.createDataFrame([(i + 1, f"C{i}", 1, 1.0, *row) for i, row in enumerate(cause_rows)], ddl)


def test_monthly_rows_and_values(spark):
    stats = monthly(spark, [(1, "AA", 2.5), (2, "DL", None)])
    assert {r["key"] for r in dicts(feeds.monthly_rows(stats))} == {"q1:row:AA:1", "q1:row:DL:2"}
    values = by(feeds.monthly_values(stats), "key", "field")
    assert len(values) == 2 * len(MONTHLY_MEASURES)
    assert values["q1:metric:cancellation_rate:AA", "1"]["value"] == 2.5


def test_series_reject_months_outside(spark):
    assert feeds.monthly_series(monthly(spark, [(4, "AA", 1.0)])).count() == 7
    with pytest.raises(PySparkException):
        feeds.monthly_series(monthly(spark, [(5, "AA", 1.0)])).collect()


def test_wide_series_keeps_gaps(spark):
    series = feeds.monthly_series(monthly(spark, [(1, "AA", 1.0), (1, "DL", 2.0), (2, "AA", 3.0)]))
    found = by(feeds.wide_series(series, "dep_delay_mean", ["AA", "DL"]), "label")
    assert (found[("Jan",)]["AA"], found[("Jan",)]["DL"]) == (1.0, 2.0)
    assert (found[("Feb",)]["AA"], found[("Feb",)]["DL"]) == (3.0, None)


def test_cause_shares(spark):
    found = by(feeds.cause_shares(ranked(spark, (1.0, 1.0, 1.0, 0.0, 0.0), (0.0,) * 5)), "rank", "cause")
    assert found[1, "carrier_delay_mean"]["share_pct"] == 33.3333
    assert {r["share_pct"] for k, r in found.items() if k[0] == 2} == {0.0}


def test_ranked_values(spark):
    found = by(feeds.ranked_values(ranked(spark, (3.0, 1.0, 0.0, 0.0, 0.0))), "key", "field")
    assert len(found) == 13
    assert found["q2:metric:carrier", "1"]["value"] == "C0"
    assert found["q2:metric:cause_pct:carrier_delay_mean", "1"]["value"] == "75.0"


def test_latest_point_may_be_null(spark):
    points = spark.createDataFrame([("s", 1, 5.0), ("s", 3, None), ("s", 2, 7.0), ("t", 1, 1.0)], "k string, o int, v double")
    found = by(feeds.latest_points(points, ["k"], "v", "o"), "k")
    assert found[("s",)] == {"k": "s", "v": None, "o": 3} and found[("t",)]["v"] == 1.0


def test_json_rows_keep_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b double")
    (row,) = dicts(feeds.json_rows(df, "key", df["a"]))
    assert row == {"key": "key", "field": "1", "payload": '{"a":1,"b":null}'}
    back = feeds.parse_json_rows(feeds.json_rows(df, "key", df["a"]), "a int, b double", drop=["b"], rename={"a": "A"})
    assert dicts(back) == [{"A": 1}]


def test_metadata_row(spark):
    (row,) = dicts(feeds.metadata_row(spark, "bench:meta", {"source": "log.csv"}))
    assert row["field"] == "metadata" and '"source":"log.csv"' in row["payload"] and "generated_at" in row["payload"]
