import pytest

from delayscope.operators import compare, feeds
from tests.helpers import by, dicts


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, a string, b string")


def test_values_that_agree(spark):
    left = table(spark, [("1", "1.00004", ""), ("2 ", "A ", None), ("3", "x", "5.0")])
    right = table(spark, [("1", "1.0", None), ("2", "A", " "), ("3", "x", "5")])
    assert compare.results_agree(compare.diff_results(left, right, ["k"], ["a", "b"]))


def test_every_kind_of_difference(spark):
    left = table(spark, [("1", "x", "1"), ("2", "1", "1"), ("3", "1", "1"), ("4", "1", "1"), ("4", "9", "1")])
    right = table(spark, [("1", "y", "1"), ("2", "1", "2"), ("5", "1", "1"), ("4", "1", "1"), ("6", "1", "1"), ("6", "1", "1")])
    found = {(r["k"], r["kind"], r["column"], r["left_value"], r["right_value"]) for r in
             dicts(compare.diff_results(left, right, ["k"], ["a", "b"]))}
    assert found == {
        ("1", "value", "a", "x", "y"),
        ("2", "value", "b", "1", "2"),
        ("3", "only_left", None, None, None),
        ("4", "duplicate_left", None, "2", "1"),
        ("5", "only_right", None, None, None),
        ("6", "only_right", None, None, None),
        ("6", "duplicate_right", None, "0", "2"),
    }


def test_null_values_are_not_absent_rows(spark):
    left = table(spark, [("1", None, None)])
    right = table(spark, [("1", None, "2")])
    (row,) = dicts(compare.diff_results(left, right, ["k"], ["a", "b"]))
    assert (row["kind"], row["column"], row["left_value"]) == ("value", "b", None)


def test_missing_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="lacks columns"):
        compare.diff_results(table(spark, []), table(spark, []).drop("b"), ["k"], ["a", "b"])


def test_key_sets(spark):
    left, right = table(spark, [("1", "", ""), ("2", "", "")]), table(spark, [("2", "", ""), ("3", "", "")])
    assert {k[0]: r["membership"] for k, r in by(compare.key_sets(left, right, ["k"]), "k").items()} == {
        "1": "only_left", "2": "both", "3": "only_right",
    }


def test_order(spark):
    stats = spark.createDataFrame(
        [("A", 1, 3.0), ("B", 1, 2.0)], "carrier string, num_flights long, arrdelay_mean double"
    )
    for cause in feeds.CAUSE_MEANS:
        stats = stats.selectExpr("*", f"0.0D as {cause}")
    ranked = feeds.ranked_carriers(stats)
    assert compare.diff_order(ranked, ranked, ["carrier"], "rank").isEmpty()
    other = ranked.selectExpr("3 - rank as rank", "carrier")
    assert {r["rank"] for r in dicts(compare.diff_order(ranked, other, ["carrier"], "rank"))} == {"1", "2"}


def test_registered_results_name_real_columns():
    for keys, values in compare.RESULTS.values():
        assert keys and values and not set(keys) & set(values)
