"""Digests: merging, bounds of size and rank, deterministic parts; percentiles selected by rank."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from delayscope.operators import digest, percentiles
from delayscope.operators.digest import build_digests, digest_by, digest_rank_check, merge_digests, read_digests
from tests.helpers import by

PROBABILITIES = (0.001, 0.01, 0.25, 0.5, 0.9, 0.99, 0.999)


@pytest.fixture(scope="module")
def values(spark):
    """A skewed group with most rows, a constant one, a tiny one, nulls and NaN."""
    rng = random.Random(5)
    rows = [("hot", rng.randrange(6), rng.lognormvariate(0, 2)) for _ in range(20_000)]
    rows += [("flat", 0, 7.0)] * 500 + [("tiny", 1, 1.0), ("tiny", 2, 2.0), ("none", 0, None), ("none", 0, float("nan")), ("hot", 1, None)]
    return spark.createDataFrame(rows, "k string, part int, v double").repartition(7).cache()


def test_estimates_keep_the_stated_rank_bound(values):
    known = values.where("v IS NOT NULL AND NOT isnan(v)")
    for centroids, levels in ((build_digests(values, ["k"], "v"), 3), (merge_digests(digest_by(values, ["k"], "part", "v"), ["k"]), 2)):
        estimates = read_digests(centroids, ["k"], PROBABILITIES, digits=None)
        checked = by(digest_rank_check(known, estimates, ["k"], "v", PROBABILITIES, levels), "k")
        assert {k[0]: r["n"] for k, r in checked.items()} == {"hot": 20_000, "flat": 500, "tiny": 2}
        assert all(r[f"{percentiles.percentile_name(p)}_ok"] for r in checked.values() for p in PROBABILITIES)


def test_centroids_are_few_and_narrow_at_the_ends(values):
    rows = build_digests(values.where("k = 'hot' AND v IS NOT NULL"), ["k"], "v").orderBy(F.col("total") / F.col("weight")).collect()
    assert len(rows) <= digest.COMPRESSION + 1
    weights = np.array([r["weight"] for r in rows])
    assert weights.sum() == 20_000 and weights[0] < 60 and weights[-1] < 60 and weights.max() > 300
    middle = (np.cumsum(weights) - weights / 2) / weights.sum()
    assert (weights <= 2.2 * math.pi / digest.COMPRESSION * np.sqrt(middle * (1 - middle)) * weights.sum() + 60).all()


def test_ends_and_constant_groups_are_exact(values):
    found = by(read_digests(build_digests(values, ["k"], "v"), ["k"], [0.0, 0.5, 1.0], digits=None), "k")
    exact = values.where("k = 'hot' AND v IS NOT NULL").agg(F.min("v"), F.max("v")).first()
    assert (found["hot",]["p0"], found["hot",]["p100"]) == (exact[0], exact[1])
    assert (found["flat",]["p0"], found["flat",]["p50"], found["flat",]["p100"]) == (7.0, 7.0, 7.0)
    assert ("none",) not in found
    assert read_digests(build_digests(values.limit(0), ["k"], "v"), ["k"], [0.5]).count() == 0


def test_parts_roll_up_the_same_way_whatever_the_partitions(values):
    def rolled(df):
        return sorted(map(tuple, merge_digests(digest_by(df, ["k"], "part", "v"), ["k"]).select("k", "weight", "low", "high").collect()))

    assert rolled(values) == rolled(values.repartition(3, "v"))


def test_selected_percentiles_are_exact(spark):
    rng = np.random.default_rng(3)
    groups = {
        "raw": rng.standard_normal(30_000), "tied": rng.integers(0, 4, 25_000).astype(float), "two": np.array([1.0, 5.0]), "one": np.array([3.0]),
        "outlier": np.concatenate([rng.random(12_000), [1e300, -1e300]]), None: np.arange(11.0),
    }
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("raw", None), ("null", None)]
    table = spark.createDataFrame(rows, "k string, v double").repartition(5)
    probabilities = (0.0, 0.25, 0.5, 0.75, 0.999, 1.0)
    found = by(percentiles.interpolated_by_rank(table, ["k"], "v", probabilities), "k")
    assert set(found) == {(k,) for k in groups}
    for k, vs in groups.items():
        assert found[k,]["n"] == len(vs)
        for p in probabilities:
            want = float(np.quantile(vs, p))
            assert found[k,][percentiles.percentile_name(p)] == pytest.approx(want, rel=1e-12), (k, p)


def test_selection_orders_a_small_part_of_a_large_group(spark):
    """No operator after the pre-count sees more than the brackets' share of the rows."""
    table = spark.range(200_000).select(F.lit("k").alias("k"), F.rand(1).alias("v"))
    found = percentiles.interpolated_by_rank(table, ["k"], "v", [0.25, 0.5], accuracy=1000)
    assert found.first()["n"] == 200_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "percentile_approx" in plan and "Window" in plan and "collect_list" not in plan
