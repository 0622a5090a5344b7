"""Tables replaced in one step, upserts of touched folders, one ordered CSV file."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from delayscope.sinks import files as sinks
from delayscope.sinks import store, upserts, versions
from delayscope.sources import files as sources
from tests.helpers import dicts


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def held(df):
    return sorted(r["v"] for r in df.collect())


def test_a_reader_sees_the_old_or_the_new_version(spark, tmp_path):
    root = f"{tmp_path}/t"
    assert versions.current_version(spark, root) is None
    with pytest.raises(ValueError):
        versions.read_version(spark, root)
    versions.publish_version(frame(spark, 1, 2), root)
    before = versions.read_version(spark, root)
    name = versions.write_version(frame(spark, 3), root)
    assert held(versions.read_version(spark, root)) == [1, 2]
    versions.switch_version(spark, root, name)
    assert held(before) == [1, 2] and held(versions.read_version(spark, root)) == [3]
    versions.publish_version(frame(spark).limit(0), root)
    assert held(versions.read_version(spark, root)) == []


def test_a_job_that_dies_leaves_the_old_version(spark, tmp_path):
    root = f"{tmp_path}/t"
    versions.publish_version(frame(spark, 1), root)
    with pytest.raises(Exception, match="half way"):
        versions.publish_version(frame(spark, 5, 6).select(F.when(F.col("v") == 6, F.raise_error(F.lit("half way")).cast("int")).otherwise(F.col("v")).alias("v")), root)
    assert held(versions.read_version(spark, root)) == [1]
    assert not [n for n in os.listdir(root) if n.startswith(".current.json") and not n.endswith(".crc")]


def test_expired_versions_go_and_unpublished_ones_too(spark, tmp_path):
    root = f"{tmp_path}/t"
    names = [versions.publish_version(frame(spark, k), root) for k in range(4)]
    lost = versions.write_version(frame(spark, 9), root)
    assert set(versions.expire_versions(spark, root, keep=2)) == {names[0], names[1], lost}
    assert held(versions.read_version(spark, root)) == [3]
    assert versions.expire_versions(spark, root, keep=2) == []


def points(spark, rows):
    return spark.createDataFrame(rows, "series string, at int, value double, seq long")


def test_upserts_equal_the_batch_and_touch_only_their_folders(spark, tmp_path):
    rng = random.Random(2)
    events = [(f"s{rng.randrange(30)}", rng.randrange(20), float(k % 50), k) for k in range(1500)]
    path = f"{tmp_path}/series"
    for part in (events[500:1000], events[1000:], events[:500]):
        upserts.upsert_points(points(spark, part), path, ["series", "at"], "value", "seq", buckets=16)
    want = {}
    for s, at, v, k in events:
        want[s, at] = (v, k)
    assert {(r["series"], r["at"]): (r["value"], r["seq"]) for r in upserts.read_points(spark, path).collect()} == want

    def files():
        return {d: sorted(n for n in os.listdir(f"{path}/{d}") if n.startswith("part-")) for d in os.listdir(path) if d.startswith("bucket=")}

    before = files()
    late = points(spark, [("s1", 3, 999.0, -1)])
    assert upserts.upsert_points(late, path, ["series", "at"], "value", "seq", buckets=16) == 1
    after = files()
    assert sum(before[d] != after[d] for d in before) == 1 and set(before) == set(after)
    assert {(r["series"], r["at"]): (r["value"], r["seq"]) for r in upserts.read_points(spark, path).collect()} == {("s1", 3): (999.0, -1), **want}
    assert upserts.upsert_points(late.limit(0), path, ["series", "at"], "value", "seq", buckets=16) == 0


def test_upsert_ties_and_repeated_updates(spark, tmp_path):
    path = f"{tmp_path}/series"
    rows = points(spark, [("a", 1, 5.0, 7), ("a", 1, 9.0, 7), (None, 1, 2.0, 1)])
    for _ in range(2):
        upserts.upsert_points(rows, path, ["series", "at"], "value", "seq", buckets=4)
    assert sorted((r["series"] or "", r["value"]) for r in dicts(upserts.read_points(spark, path))) == [("", 2.0), ("a", 9.0)]


def test_one_ordered_file_from_many_parts(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.concat(F.lit('a "b", '), F.col("id")).alias("a,b")).repartition(9)
    path = f"{tmp_path}/out"
    for _ in range(2):
        sinks.write_csv(df, path, order_by=["k"], single_file=True)
    assert sorted(n for n in os.listdir(path) if not n.startswith(".")) == ["_SUCCESS", "part-00000.csv"]
    with open(f"{path}/part-00000.csv", newline="") as lines:
        header, *rows = csv.reader(lines, escapechar="\\", doublequote=False)
    assert header == ["k", "a,b"] and [int(r[0]) for r in rows] == list(range(5000))
    assert sources.read_result(spark, path).count() == 5000
    sinks.write_csv(df.limit(0), path, order_by=["k"], single_file=True)
    assert sources.read_result(spark, path).columns == ["k", "a,b"] and sources.read_result(spark, path).count() == 0


def test_small_text_files_are_replaced_whole(spark, tmp_path):
    path = f"{tmp_path}/note.txt"
    assert store.read_text(spark, path) is None
    for text in ("first", "second é"):
        store.write_text(spark, path, text)
        assert store.read_text(spark, path) == text
    assert store.names(spark, f"{tmp_path}") == ["note.txt"] or ".note.txt" not in " ".join(store.names(spark, f"{tmp_path}"))
