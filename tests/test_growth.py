"""What must not grow faster than the input: generated code, passes over the view, files written by one task."""

import contextlib
import io
import re
import tarfile

import pandas as pd
import pytest

from delayscope.operators import hourly, percentiles
from delayscope.schema import RAW_SCHEMA
from delayscope.sources import files as sources
from tests import helpers
from verification import inputs, registry
from verification.registry import REGISTRY

#: Bytes of a method from where on the JVM interprets it.
HUGE = 8000


def largest_method(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())), default=0)


def test_conversions_of_many_columns_are_compiled(spark, tmp_path):
    text = spark.createDataFrame([("1",) * len(RAW_SCHEMA)], ", ".join(f"{n} string" for n in RAW_SCHEMA.fieldNames()))
    text.write.parquet(f"{tmp_path}/text")
    stored = spark.read.parquet(f"{tmp_path}/text")
    assert largest_method(sources.convert_by_name(stored)) < HUGE
    assert largest_method(sources.convert_raw(stored)) < HUGE


@pytest.fixture
def three_files(spark, tmp_path, small):
    """The small line items as three files, so that a scan has three tasks."""
    spark.read.parquet(f"{small}/lineitem.parquet").repartition(3).write.parquet(f"{tmp_path}/in/lineitem.parquet")
    return f"{tmp_path}/in"


@pytest.fixture
def rows_of_view(spark, monkeypatch):
    """Counts the rows that the view of raw flights gives out, over all passes."""
    seen, view = spark.sparkContext.accumulator(0), inputs.raw_flights

    def counted(spark, sf):
        def pass_on(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        raw = view(spark, sf)
        return raw.mapInArrow(pass_on, raw.schema)

    monkeypatch.setattr(inputs, "raw_flights", counted)
    return seen


def test_files_of_several_layouts_take_one_pass(spark, three_files, rows_of_view):
    rows = REGISTRY["csv_by_name_mixed"](spark, three_files).count()
    assert rows_of_view.value == rows == spark.read.parquet(f"{three_files}/lineitem.parquet").count()


def test_increments_of_the_running_profile_take_one_pass(spark, three_files, rows_of_view):
    assert REGISTRY["dq_running"](spark, three_files).count() > 0
    assert rows_of_view.value == spark.read.parquet(f"{three_files}/lineitem.parquet").count()


def test_drops_are_written_by_many_tasks_and_taken_when_all_are_there(spark, three_files, rows_of_view, monkeypatch):
    taken, ingest = [], registry.ingest_when_quiet

    def watched(spark, notes, table, done, **limits):
        ingest(spark, notes, table, done, **limits)
        (folder,) = {r["folder"] for r in spark.read.json(notes).collect()}
        files, rows = sources.landed_files(spark, folder).count(), spark.read.schema(RAW_SCHEMA).option("header", True).csv(folder).count()
        polls = {r["round"]: r["files"] for r in spark.read.json(notes).collect()}
        taken.append((files, rows, polls, limits))

    monkeypatch.setattr(registry, "ingest_when_quiet", watched)
    spark.conf.set("spark.sql.files.openCostInBytes", 128 << 20)  # a stored file is a task
    try:
        out = REGISTRY["ingest_when_complete"](spark, three_files).count()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    ((files, rows, polls, limits),) = taken
    assert files > 4 and rows == rows_of_view.value == spark.read.parquet(f"{three_files}/lineitem.parquet").count()
    assert limits["least_files"] == files and [polls[n] for n in (0, 4, 8)] == sorted({polls[0], polls[4], files})
    assert out == inputs.flights(spark, three_files).count()


def test_packed_lines_are_the_lines_spark_wrote():
    lines = [",".join([str(k)] + [""] * (len(RAW_SCHEMA) - 1)) for k in range(700)]
    stream = b"".join(v.encode() + b"\n" for f in registry._tar_rows([pd.DataFrame({"line": lines})]) for v in f["value"])
    with tarfile.open(fileobj=io.BytesIO(stream)) as packed:
        content = packed.extractfile("data/flights_0.csv").read().decode()
    assert content == "\n".join([",".join(RAW_SCHEMA.fieldNames()), *lines, ""])


def test_approximate_ranks_keep_their_bound_in_groups_of_few_flights(spark):
    delays = [float(d) for d in range(1, 100)]
    flown = helpers.flights(spark, [{"DEP_DELAY": d} for d in delays]).coalesce(1)
    shares = [k / 100 for k in range(5, 100, 5)]
    (found,) = helpers.dicts(hourly.hourly_percentiles_approx(flown, probabilities=shares, accuracy=100))
    got = {p: found[percentiles.percentile_name(p)] for p in shares}
    # One rank of 99 is more than one part in 100.
    assert got == {p: float(-(-round(p * 100) * 99 // 100)) for p in shares}
