"""Quality counters kept up to date: partial states per source file, merged on demand.

A state is what ``quality_profile`` counts a file's records into, per month and carrier: a
few thousand small rows a file, however long the file. They add up, so a report over all
files needs the states alone, and a rerun reads only files that are new or were replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayscope.operators import quality
from delayscope.sinks import versions

FILE = ["file", "length", "modified"]
_KEYS = ["MONTH", "OP_UNIQUE_CARRIER", "_answers"]


def file_states(records: DataFrame) -> DataFrame:
    """Partial states of raw records that carry the columns of ``FILE``."""
    return quality.AnswerCounts(records, by=[*FILE, "MONTH", "OP_UNIQUE_CARRIER"]).frame


def update_states(spark: SparkSession, files: DataFrame, read: Callable[[list[str]], DataFrame], root: str) -> tuple[int, int]:
    """Bring the states at ``root`` up to date with the files that are there now.

    ``files`` (path, length, modificationTime) lists them; ``read`` gives the raw records of
    some paths. Files without a state of the same length and time are read; states of files
    that are gone or were replaced are left out. The new states replace the old ones in one
    step. Returns the numbers of files read and of files whose states were dropped.
    """
    listed = files.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))
    there = {(r["file"], r["length"], r["modified"]) for r in listed.toLocalIterator()}
    before = versions.current_version(spark, root)
    states = None if before is None else spark.read.parquet(before)
    known = set() if states is None else {(r["file"], r["length"], r["modified"]) for r in states.select(*FILE).distinct().toLocalIterator()}
    new, gone = there - known, known - there
    parts = []
    if states is not None:
        parts.append(states.join(F.broadcast(spark.createDataFrame(sorted(gone), listed.schema)), FILE, "left_anti") if gone else states)
    if new:
        identity = spark.createDataFrame(sorted(new), listed.schema)
        records = read(sorted(f for f, _, _ in new)).withColumn("file", F.col("_metadata.file_path"))
        named = identity.select(F.regexp_replace("file", "^file:/+", "file:///").alias("_path"), *FILE)
        same = F.regexp_replace(F.col("file"), "^file:/+", "file:///")
        fresh = records.withColumn("_path", same).drop("file").join(F.broadcast(named), "_path").drop("_path")
        parts.append(file_states(fresh))
    if new or gone:
        merged = parts[0]
        for part in parts[1:]:
            merged = merged.unionByName(part)
        versions.publish_version(merged, root)
    return len(new), len(gone)


def states_at(spark: SparkSession, root: str) -> DataFrame:
    return versions.read_version(spark, root)


def profile_of(states: DataFrame) -> DataFrame:
    """The quality profile of all files, from their states alone: (metric, value)."""
    return quality.profile_from(quality.MergedCounts(states))


def missing_causes_of(states: DataFrame) -> DataFrame:
    """Late flights without any cause per file and in total, from the states alone."""
    return quality.missing_causes_from(quality.MergedCounts(states, by=["file"]), "file")


def row_counts_of(states: DataFrame) -> DataFrame:
    """Rows per month, per carrier and in total, from the states alone."""
    counted = states.groupBy("MONTH", "OP_UNIQUE_CARRIER").agg(F.sum("_n").alias("_n"))
    return quality.row_counts_from(counted)
