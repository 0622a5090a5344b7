import random

from pyspark.sql import functions as F

from delayscope.operators.ranking import first_k, number_rows
from tests.helpers import dicts


def rows(n=3000):
    random.seed(3)
    # One key holds most rows; some keys and order values are NULL.
    return [
        (random.choice(["hot", "hot", "hot", "b", None]), random.choice([None, *range(400)]), i) for i in range(n)
    ]


def expected(data):
    groups = {}
    for key, order, i in data:
        groups.setdefault(key, []).append((order is not None, order or 0, i))
    return {g[2]: place for values in groups.values() for place, g in enumerate(sorted(values), start=1)}


def test_row_numbers_across_buckets(spark):
    data = rows()
    df = spark.createDataFrame(data, "k string, o int, i int")
    numbered = number_rows(df, ["k"], [F.floor(F.col("o") / 50)], ["o", "i"])
    assert {r["i"]: r["position"] for r in dicts(numbered)} == expected(data)


def test_row_numbers_share_one_shuffle_of_the_rows(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as o")
    plan = number_rows(df, ["k"], [F.floor(F.col("o") / 100)], ["o"])._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.split("\n") if "Exchange hashpartitioning(_spot" in line]
    assert 1 <= len(moved) <= 2


def test_first_k(spark):
    df = spark.createDataFrame(rows(), "k string, o int, i int")
    want = {i: place for i, place in expected(rows()).items() if place <= 7}
    found = first_k(df, ["k"], [F.col("o").asc_nulls_first(), "i"], 7)
    assert {r["i"]: r["position"] for r in dicts(found)} == want


def test_first_k_cuts_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 as k", "id as o")
    plan = first_k(df, ["k"], ["o"], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
