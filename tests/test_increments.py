"""What is kept up to date in steps: quality states per file, the landing watch, the duplicate audit."""

import os

import pytest
from pyspark.sql import functions as F

from delayscope.operators import quality, running_quality
from delayscope.schema import FLIGHT_KEY, RAW_SCHEMA
from delayscope.sources import files as sources
from delayscope.streaming.landing import NOTES, ingest_when_quiet, poll_landing, released_folders
from tests.helpers import by, dicts, raw

NAMES = RAW_SCHEMA.fieldNames()


def write(path, rows):
    lines = [",".join(NAMES), *(",".join(str(r.get(n, "")) for n in NAMES) for r in rows)]
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def late(month, carrier="AA", **more):
    return {"YEAR": 2025, "MONTH": month, "OP_UNIQUE_CARRIER": carrier, "ARR_DELAY": 30, "CANCELLED": "0.0", "DIVERTED": "0.0", **more}


def test_states_follow_new_replaced_and_removed_files(spark, tmp_path):
    landing, root = tmp_path / "in", f"{tmp_path}/states"
    read = []

    def reader(paths):
        read.append(len(paths))
        return sources.read_raw(spark, paths)

    def update():
        return running_quality.update_states(spark, sources.landed_files(spark, str(landing)), reader, root)

    write(landing / "a.csv", [late(1), late(1, CARRIER_DELAY=30, WEATHER_DELAY=0, NAS_DELAY=0, SECURITY_DELAY=0, LATE_AIRCRAFT_DELAY=0), late(2, "")])
    write(landing / "b.csv", [late(3, DEP_DELAY=-4)] * 5)
    assert update() == (2, 0) and update() == (0, 0) and read == [2]
    write(landing / "b.csv", [late(3, DEP_DELAY=-4)] * 2)
    os.utime(landing / "b.csv", (1, 1))
    write(landing / "c.csv", [late(9, CRS_DEP_TIME=2460)])
    assert update() == (2, 1) and read == [2, 2]
    os.remove(landing / "a.csv")
    assert update() == (0, 1) and read == [2, 2]
    states = running_quality.states_at(spark, root)
    whole = sources.read_raw(spark, str(landing))
    assert by(running_quality.profile_of(states), "metric") == by(quality.quality_profile(whole), "metric")
    assert sorted(map(str, dicts(running_quality.row_counts_of(states)))) == sorted(map(str, dicts(quality.row_counts(whole))))
    named = whole.withColumn("file", F.col("_metadata.file_path"))
    found = {(r["file"] or "").rsplit("/", 1)[-1]: list(r.values())[1:] for r in dicts(running_quality.missing_causes_of(states))}
    want = {(r["file"] or "").rsplit("/", 1)[-1]: list(r.values())[1:] for r in dicts(quality.missing_causes(named, "file"))}
    assert found == want and len(found) == 3


def months(spark, table):
    return sorted(r["MONTH"] for r in dicts(spark.read.parquet(table))) if os.path.isdir(table) else []


def test_rows_are_released_only_after_quiet_rounds(spark, tmp_path):
    landing, notes, table, done = (str(tmp_path / p) for p in ("in", "notes", "out", "progress"))
    number = iter(range(100))

    def rounds(n):
        for _ in range(n):
            poll_landing(spark, landing, notes, next(number))
        ingest_when_quiet(spark, notes, table, done)
        return months(spark, table)

    for m in (1, 2):
        write(tmp_path / "in" / f"{m}.csv", [late(m)])
    write(tmp_path / "in" / ".hidden.csv", [late(7)])
    assert rounds(5) == []  # quiet, but two files
    write(tmp_path / "in" / "3.csv", [late(3)])
    write(tmp_path / "in" / "4.csv", [late(4)])
    assert rounds(3) == []  # four files, the last change two rounds ago
    assert rounds(1) == [1, 2, 3, 4]  # three quiet rounds, across a restart
    assert rounds(2) == [1, 2, 3, 4]
    write(tmp_path / "in" / "5.csv", [late(5)])
    assert rounds(3) == [1, 2, 3, 4]
    assert rounds(1) == [1, 2, 3, 4, 5]


def test_a_folder_that_keeps_changing_or_a_poll_that_repeats(spark, tmp_path):
    rows = [("a", k, 4 + k, 10, None) for k in range(6)] + [("b", k // 2, 4, 10, None) for k in range(6)] + [("c", k, 4, 10, None) for k in range(4)]
    spark.createDataFrame(rows, NOTES).coalesce(1).write.json(f"{tmp_path}/notes")
    stream = released_folders(spark.readStream.schema(NOTES).json(f"{tmp_path}/notes"))
    query = stream.writeStream.format("memory").queryName("released").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [(r["folder"], r["round"]) for r in spark.table("released").collect()] == [("c", 3)]


def test_duplicate_audit_moves_only_suspects(spark):
    rows = [{"MONTH": 1, "OP_CARRIER_FL_NUM": k} for k in range(3000)] + [{"MONTH": 1, "OP_CARRIER_FL_NUM": k % 7} for k in range(20)]
    rows += [{"OP_UNIQUE_CARRIER": None, "MONTH": None}] * 3
    table = raw(spark, rows)
    assert dicts(quality.duplicate_audit(table)) == [{"duplicate_groups": 8, "rows_in_groups": 30}]
    assert quality._suspects(table, FLIGHT_KEY).count() < 400
    assert dicts(quality.duplicate_audit(table.limit(0))) == [{"duplicate_groups": 0, "rows_in_groups": 0}]


def test_duplicate_audit_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(quality, "BROADCAST_BYTES", 0)
    table = raw(spark, [{"OP_CARRIER_FL_NUM": k % 40} for k in range(100)])
    assert dicts(quality.duplicate_audit(table)) == [{"duplicate_groups": 40, "rows_in_groups": 100}]


def test_unnumbered_runs_of_a_box_stay_spread(spark):
    from delayscope.operators import timings

    log = spark.range(400).selectExpr("1 AS worker_count", "'Q1' AS query", "'df' AS impl", "'end_to_end_s' AS phase", "CASE WHEN id % 4 = 0 THEN id ELSE 0 END AS iteration", "CAST(id * 37 % 101 AS DOUBLE) AS time_s")
    found = timings.box_rows(log, width=2.0).orderBy("index").collect()
    assert [r["index"] for r in found] == list(range(400))
    order = [(r["iteration"], r["time_s"]) for r in found]
    assert order == sorted(order)
    with pytest.raises(AssertionError):
        assert found[0]["iteration"]
