import io
import os
import tarfile

import pytest
from pyspark.sql import functions as F

from delayscope.operators.cleaning import clean_flights
from delayscope.plans import jobs
from delayscope.schema import PROCESSED_COLUMNS, RAW_SCHEMA
from delayscope.sinks import files as sinks
from delayscope.sinks.scratch import scratch_path
from delayscope.sources import contract
from delayscope.sources import files as sources
from delayscope.sources.archives import Pieces, archive_lines, read_archives, records
from delayscope.streaming.landing import ingest_available
from tests.helpers import dicts, raw
from verification import inputs

NAMES = RAW_SCHEMA.fieldNames()


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def csv_line(**values):
    return ",".join(str(values.get(name, "")) for name in NAMES)


def flight(month, carrier="AA", **more):
    return csv_line(YEAR=2025, MONTH=month, OP_UNIQUE_CARRIER=carrier, CANCELLED="0.00", DIVERTED="1.00", **more)


def test_raw_csv(spark, tmp_path):
    write_lines(tmp_path / "202501_T_ONTIME_REPORTING.csv", [",".join(NAMES), flight(1, DEP_DELAY="-3.00"), flight(1, "")])
    write_lines(tmp_path / "202502_T_ONTIME_REPORTING.csv", [",".join(NAMES), flight(2, CRS_DEP_TIME="bad")])
    write_lines(tmp_path / "other.csv", [",".join(NAMES), flight(9)])
    df = sources.read_raw(spark, f"{tmp_path}/20250*_T_ONTIME_REPORTING.csv")
    assert df.schema == RAW_SCHEMA
    found = sorted((r["MONTH"], r["OP_UNIQUE_CARRIER"] or "", r["DEP_DELAY"]) for r in dicts(df))
    assert found == [(1, "", None), (1, "AA", -3.0), (2, "AA", None)]
    listed = sources.read_raw(spark, str(tmp_path), name_pattern="20250[12]*")
    assert listed.count() == 3
    named = sources.with_source_file(listed).groupBy("source_file").count()
    assert {r["source_file"] for r in dicts(named)} == {f"20250{m}_T_ONTIME_REPORTING.csv" for m in (1, 2)}
    assert clean_flights(df).count() == 2


def test_reordered_header_never_binds_by_position(spark, tmp_path):
    swapped = list(reversed(NAMES))
    write_lines(tmp_path / "a.csv", [",".join(swapped), ",".join("7" if n == "MONTH" else "" for n in swapped)])
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_raw(spark, str(tmp_path)).collect()
    (row,) = dicts(sources.read_by_name(spark, str(tmp_path)))
    assert row["MONTH"] == 7 and row["YEAR"] is None


def test_by_name_over_files_with_different_headers(spark, tmp_path):
    write_lines(tmp_path / "a" / "a.csv", [",".join(NAMES), flight(1, DEP_DELAY="1.5")])
    write_lines(tmp_path / "b" / "b.csv", ["EXTRA," + ",".join(reversed(NAMES)), "x," + ",".join(reversed(flight(2).split(",")))])
    df = sources.read_by_name(spark, [f"{tmp_path}/a", f"{tmp_path}/b"])
    assert sorted((r["MONTH"], r["OP_UNIQUE_CARRIER"], r["EXTRA"]) for r in dicts(df)) == [(1, "AA", None), (2, "AA", "x")]
    with pytest.raises(ValueError, match="lacks"):
        write_lines(tmp_path / "c" / "c.csv", ["YEAR,MONTH", "1,2"])
        sources.read_by_name(spark, f"{tmp_path}/c")


def test_contracts(spark):
    df = spark.range(1)
    assert contract.require_columns(df, ["id"]) is df and contract.require_rows(df) is df
    with pytest.raises(ValueError):
        contract.require_rows(df.limit(0))


def test_landed_files(spark, tmp_path):
    for name in ("a.csv", ".b.csv", "c.txt", "d.csv"):
        write_lines(tmp_path / name, ["x"])
    found = sources.landed_files(spark, str(tmp_path))
    assert {r["file_name"] for r in dicts(found)} == {"a.csv", "d.csv"}
    assert sources.require_landed(spark, str(tmp_path), 2) == 2
    with pytest.raises(ValueError, match="expected at least 4"):
        sources.require_landed(spark, str(tmp_path))


def archive(path, members, mode="w:gz"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with tarfile.open(path, mode) as packed:
        for name, text in members.items():
            entry = tarfile.TarInfo(name)
            entry.size = len(text.encode())
            packed.addfile(entry, io.BytesIO(text.encode()))


def test_archives(spark, tmp_path):
    table = "\n".join([",".join(reversed(NAMES)), *(",".join(reversed(flight(m).split(","))) for m in range(1, 8))])
    archive(tmp_path / "x.tar.gz", {"d/202501.csv": table, "d/.202501.csv": table, "readme.txt": "no", "empty.csv": ""})
    archive(tmp_path / "y.tar.gz", {"202502.csv": "MONTH,OP_UNIQUE_CARRIER\n9,ZZ\n"})
    text = read_archives(spark, str(tmp_path))
    assert {(r["member"], r["n"]) for r in dicts(text.groupBy("member").agg(F.count("*").alias("n")))} == {
        ("202501.csv", 7), ("202502.csv", 1),
    }
    typed = sources.convert_raw(text)
    assert typed.dtypes == [(f.name, f.dataType.simpleString()) for f in RAW_SCHEMA]
    assert sorted(r["MONTH"] for r in dicts(typed)) == [1, 2, 3, 4, 5, 6, 7, 9]
    assert {r["DIVERTED"] for r in dicts(typed.where("MONTH < 8"))} == {1.0}
    assert read_archives(spark, str(tmp_path), ["MONTH"], member_pattern="nothing").count() == 0


def test_archives_are_streamed_line_by_line(spark, tmp_path):
    """More members and longer ones than a piece; quoted line feeds, blank lines, CR LF, no final line feed."""
    members = {
        "a.csv": "MONTH,NOTE\r\n1,plain\r\n\r\n2,\"two\nlines\"\r\n3,end",
        "blob.bin": "\x01" * 5000,
        "b.csv": "NOTE,MONTH\n" + "".join(f"{'x' * (k % 600)},{k}\n" for k in range(3000)),
        "long/" + "n" * 130 + ".csv": "MONTH\n7\n",
    }
    archive(tmp_path / "gz" / "one.tar.gz", members)
    archive(tmp_path / "gz" / "two.tar.gz", {"c.csv": "MONTH\n8\n"})
    archive(tmp_path / "plain" / "three.tar", members, "w")
    want = {"a.csv": [1, 2, 3], "b.csv": list(range(3000)), "n" * 130 + ".csv": [7]}
    for path, pattern, more in ((tmp_path / "gz", "*.tar.gz", {"c.csv": [8]}), (tmp_path / "plain", "*.tar", {})):
        rows = read_archives(spark, str(path), ["MONTH", "NOTE"], pattern).collect()
        found = {}
        for r in rows:
            found.setdefault(r["member"], []).append(int(r["MONTH"]))
        assert {k: sorted(v) for k, v in found.items()} == {**want, **more}
        assert [r["NOTE"] for r in rows if r["member"] == "a.csv" and r["MONTH"] == "2"] == ["two\nlines"]
    longest = archive_lines(spark, f"{tmp_path}/gz").agg(F.max(F.length("line"))).first()[0]
    assert longest < 700


def test_pieces_give_back_the_bytes():
    data = b"ab\n\ncd" * 300 + b"\n"
    pieces = iter(data[:-1].split(b"\n"))
    stream = Pieces(lambda: next(pieces, None))
    out = b""
    while part := stream.read(7):
        out += part
    assert out == data
    assert list(records([b'a,"x\n', b'y"\n', b"b,2\r\n"])) == ['a,"x\ny"', "b,2"]


def test_landing_a_member_again_replaces_it(spark, tmp_path):
    rows = spark.createDataFrame([("a.csv", "1"), ("b.csv", "1")], "member string, v string")
    sinks.land_members(rows, f"{tmp_path}/t")
    sinks.land_members(rows.where("member = 'a.csv'").withColumn("v", F.lit("2")), f"{tmp_path}/t")
    assert {(r["member"], r["v"]) for r in dicts(spark.read.parquet(f"{tmp_path}/t"))} == {("a.csv", "2"), ("b.csv", "1")}


def test_incremental_ingestion_takes_each_file_once(spark, tmp_path):
    landing, table, done = (str(tmp_path / p) for p in ("in", "out", "progress"))
    write_lines(tmp_path / "in" / "a.csv", [",".join(NAMES), flight(1), flight(2)])
    write_lines(tmp_path / "in" / "notes.txt", ["nothing"])
    ingest_available(spark, landing, table, done)
    ingest_available(spark, landing, table, done)
    assert sorted(r["MONTH"] for r in dicts(spark.read.parquet(table))) == [1, 2]
    write_lines(tmp_path / "in" / "b.csv", [",".join(NAMES), flight(3), flight(4, "")])
    ingest_available(spark, landing, table, done, files_per_batch=1)
    df = spark.read.parquet(table)
    assert df.columns == PROCESSED_COLUMNS and sorted(r["MONTH"] for r in dicts(df)) == [1, 2, 3]


def test_processed_write_reports_its_rows(spark, tmp_path):
    df = clean_flights(raw(spark, [{"MONTH": m} for m in range(1, 6)]))
    assert sinks.write_processed(df, f"{tmp_path}/p") == 5
    assert sinks.write_processed(df, f"{tmp_path}/c", partition_by="OP_UNIQUE_CARRIER") == 5
    assert os.path.isdir(f"{tmp_path}/c/OP_UNIQUE_CARRIER=AA")
    assert sources.read_processed(spark, f"{tmp_path}/c", ["MONTH"]).columns == ["MONTH"]


def test_single_result_file_is_ordered(spark, tmp_path):
    df = spark.createDataFrame([(i % 7, None) for i in range(50)], "k int, v string").repartition(5)
    sinks.write_csv(df, f"{tmp_path}/r", order_by=["k"], single_file=True)
    (part,) = [f for f in os.listdir(f"{tmp_path}/r") if f.startswith("part-")]
    lines = (tmp_path / "r" / part).read_text().splitlines()
    assert lines[0] == "k,v" and lines[1:] == sorted(lines[1:])
    back = sources.read_result(spark, f"{tmp_path}/r")
    assert {r["v"] for r in dicts(back)} == {""} and dict(back.dtypes) == {"k": "string", "v": "string"}


def test_feeds_are_replaced_one_by_one(spark, tmp_path):
    one, two = (spark.createDataFrame([(k, 1.0)], "key string, value double") for k in ("a", "b"))
    for df, feed in ((one, "x"), (two, "y"), (one, "x")):
        sinks.publish_feed(df, f"{tmp_path}/f", feed)
    assert sorted((r["key"], r["feed"]) for r in dicts(spark.read.parquet(f"{tmp_path}/f"))) == [("a", "x"), ("b", "y")]
    sinks.publish_feed(one.limit(0), f"{tmp_path}/f", "x")
    assert [(r["key"], r["feed"]) for r in dicts(spark.read.parquet(f"{tmp_path}/f"))] == [("b", "y")]


class Session:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.conf = {key.replace("_", "."): value for key, value in settings.items()}


def test_scratch_is_never_reused_and_follows_the_session(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert scratch_path(Session(spark_checkpoint_dir="hdfs://c/tmp/"), "a").startswith("hdfs://c/tmp/a-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(spark_master="yarn"), "a")


def test_whole_pipeline(spark, tmp_path, small):
    source, facts, out, served = (str(tmp_path / p) for p in ("csv", "facts", "out", "served"))
    data = inputs.raw_flights(spark, small)
    sinks.write_csv(data, source)
    assert jobs.clean_job(spark, source, facts) == data.where("OP_UNIQUE_CARRIER is not null").count()
    jobs.monthly_job(spark, facts, out)
    jobs.carriers_job(spark, facts, out, min_flights=300)
    jobs.hourly_job(spark, facts, out)
    status = {r["output"]: r for r in dicts(jobs.results_status(spark, out))}
    assert set(status) == set(jobs.RESULT_NAMES) and all(r["ready"] for r in status.values())
    assert all(r["part_files"] == 1 for r in status.values())
    sinks.require_outputs(jobs.results_status(spark, out))
    jobs.feeds_job(spark, out, served, months=range(1, 13))
    values = spark.read.parquet(f"{served}/values").groupBy("feed").count()
    assert {r["feed"] for r in dicts(values)} == {"q1", "q2", "q3"}
    assert spark.read.parquet(f"{served}/series").where("feed = 'q3'").count() == 5 * status[jobs.PERCENTILES]["rows"]
    for feed, result in (("monthly_rows", jobs.MONTHLY), ("ranked_rows", jobs.TOP_CARRIERS), ("hourly_rows", jobs.PERCENTILES), ("extreme_rows", jobs.EXTREMES)):
        assert spark.read.parquet(f"{served}/{feed}").count() == status[result]["rows"]
    assert spark.read.parquet(f"{served}/cause_shares").select("rank").distinct().count() == 10
    top = sources.read_result(spark, f"{out}/{jobs.TOP_CARRIERS}")
    means = [float(r["arrdelay_mean"]) for r in top.collect()]
    assert means == sorted(means, reverse=True) and len(means) == 10
    jobs.quality_job(spark, source, f"{out}/quality")
    assert spark.read.parquet(f"{out}/quality/missing_causes").where("source_file is null").count() == 1


def test_absent_output_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)not.exist|not found"):
        jobs.results_status(spark, f"{tmp_path}/nowhere").collect()
    empty = f"{tmp_path}/empty"
    spark.range(0).write.parquet(empty)
    with pytest.raises(ValueError, match="not ready"):
        sinks.require_outputs(sinks.output_status(spark, {"empty": ("parquet", empty)}))
