import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from delayscope import functions as fn
from delayscope.functions.measures import delay_band
from tests.helpers import dicts


def column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def evaluated(spark, values, kind, expression):
    rows = column(spark, values, kind).select("i", expression.alias("r")).orderBy("i").collect()
    return [row["r"] for row in rows]


def test_numbers_from_text(spark):
    texts = ["12", " 12.5 ", "", None, "bad", "1e3", "10d", "nan", "-7"]
    assert evaluated(spark, texts, "string", fn.number("v")) == [12, 12.5, None, None, None, 1000, None, None, -7]
    assert evaluated(spark, texts, "string", fn.whole("v")) == [12, 12, None, None, None, 1000, None, None, -7]
    assert evaluated(spark, texts, "string", fn.whole_or_zero("v")) == [12, 12, 0, 0, 0, 1000, 0, 0, -7]
    assert evaluated(spark, ["x", "2"], "string", fn.number_or_zero("v")) == [0.0, 2.0]
    large = ["3000000000", "0x1p3", "1e30"]
    assert evaluated(spark, large, "string", fn.whole_or_zero("v")) == [3_000_000_000, 0, None]


def test_first_filled(spark):
    df = spark.createDataFrame([(None, " ", "c"), ("a", "b", None), (None, None, None)], "x string, y string, z string")
    assert [r[0] for r in df.select(fn.first_filled("x", "y", "z")).collect()] == ["c", "a", None]


def test_hour_of(spark):
    clocks = [2400, 2359, 0, 59, -50, None, 1267]
    assert evaluated(spark, clocks, "int", fn.hour_of("v")) == [24, 23, 0, 0, -1, None, 12]
    assert evaluated(spark, clocks, "int", fn.bad_minutes("v")) == [False, False, False, False, False, None, True]


def test_month_and_hour_starts(spark):
    stamps = evaluated(spark, [1, 4], "int", fn.month_start("v"))
    assert [(s.year, s.month, s.day, s.hour) for s in stamps] == [(2025, 1, 1, 0), (2025, 4, 1, 0)]
    assert [s.hour for s in evaluated(spark, [0, 23], "int", fn.hour_start("v"))] == [0, 23]
    for expression, bad in ((fn.month_start("v"), 5), (fn.hour_start("v"), 24), (fn.hour_start("v"), -1)):
        with pytest.raises(PySparkException):
            evaluated(spark, [bad], "int", expression)


def test_delay_band(spark):
    delays = [0.0, 15.0, -3.0, 14.5, 0.5, None]
    assert evaluated(spark, delays, "double", delay_band("v")) == ["le_0", "ge_15", "le_0", "gt_0_lt_15", "gt_0_lt_15", None]


def test_cause_expressions(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (None, None)], "a double, b double")
    found = dicts(
        df.select(
            fn.cause_total(["a", "b"]).alias("total"), fn.all_null(["a", "b"]).alias("all"), fn.any_null(["a", "b"]).alias("any")
        )
    )
    assert found == [
        {"total": 3.0, "all": False, "any": False},
        {"total": None, "all": False, "any": True},
        {"total": None, "all": True, "any": True},
    ]


def test_percentages(spark):
    df = spark.createDataFrame([(1, 4), (1, 0)], "a int, b int")
    assert [r[0] for r in df.select(fn.percent("a", "b")).collect()] == [25.0, None]
    assert [r[0] for r in df.select(fn.share_percent("a", "b")).collect()] == [25.0, 0.0]


def test_binary_round_equals_python_round(spark):
    random.seed(7)
    values = [0.125, 0.375, 2.675, 1.005, 1.015, -0.125, -2.675, 0.0, 2.5, 1e12 + 0.3, 123456789012.3456]
    values += [random.randint(-10**6, 10**6) / 1000 for _ in range(3000)]
    values += [random.randint(-10**6, 10**6) / 8 for _ in range(1000)]
    values += [random.uniform(-1e4, 1e4) for _ in range(1000)]
    for digits in (0, 2, 3, 4):
        got = evaluated(spark, values, "double", fn.binary_round("v", digits))
        wrong = [(v, g) for v, g in zip(values, got) if g != round(v, digits)]
        assert not wrong
    texts = evaluated(spark, values, "double", fn.number_text("v"))
    wrong = [(v, t) for v, t in zip(values, texts) if float(t) != float(f"{v:.2f}")]
    assert not wrong


def test_texts(spark):
    assert evaluated(spark, [1.5, None], "double", fn.number_text("v")) == ["1.50", "—"]
    df = spark.createDataFrame([(1.0, 0.25), (1.0, None), (None, 1.0)], "m double, s double")
    assert [r[0] for r in df.select(fn.mean_std_text("m", "s")).collect()] == ["1.00 ± 0.25", "1.00", "—"]
    assert evaluated(spark, [1234567.5], "double", fn.thousands("v", 2)) == ["1.234.567,50"]
    assert evaluated(spark, [1234567], "long", fn.thousands("v")) == ["1.234.567"]


def test_close_to(spark):
    df = spark.createDataFrame(
        [(1.0, 1.00004), (1.0, 1.01), (1e9, 1e9 + 1), (float("inf"), float("inf")), (float("nan"), float("nan")),
         (float("inf"), 1.0), (2.0, float("inf"))],
        "a double, b double",
    )
    close = fn.close_to(F.col("a"), F.col("b"), 1e-4, 1e-4)
    assert [r[0] for r in df.select(close).collect()] == [True, False, True, True, False, False, False]
