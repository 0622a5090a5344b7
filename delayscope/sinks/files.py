"""Writers of processed tables, results and feeds."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from delayscope.sinks import store
from delayscope.sinks.scratch import discard, scratch_path


def write_processed(df: DataFrame, path: str, partition_by: str | None = None) -> int:
    """Replace a processed Parquet table; the number of rows is counted while writing.

    With ``partition_by`` rows move to their partition first, so a partition is not
    scattered over a file per task. Rebalancing splits a hot partition into several files.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_by:
        counted = counted.hint("rebalance", partition_by)
    writer = counted.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def write_csv(df: DataFrame, path: str, order_by: Sequence[str] = (), single_file: bool = False) -> None:
    """Replace a CSV output with header.

    ``single_file`` gives one file with one header, its rows in the order of ``order_by``:
    the rows are sorted and written as parts in parallel, which the file system then joins
    in order, so no task ever holds all rows.
    """
    shaped = df.orderBy(*order_by) if order_by else df
    if not single_file:
        shaped.write.mode("overwrite").option("header", True).csv(path)
        return
    spark = df.sparkSession
    parts, ready = scratch_path(spark, "csv-parts"), f"{path}.{uuid.uuid4().hex}.new"
    shaped.write.option("header", False).csv(parts)
    store.write_text(spark, f"{ready}/part-00000.csv", ",".join(map(_csv_name, df.columns)) + "\n")
    files = [f"{parts}/{name}" for name in store.names(spark, parts) if name.startswith("part-")]
    store.join_files(spark, files, f"{ready}/part-00000.csv")
    store.write_text(spark, f"{ready}/_SUCCESS", "")
    store.remove(spark, path)
    store.rename(spark, ready, path)
    discard(spark, parts)


def _csv_name(name: str) -> str:
    """A column name as a CSV header holds it."""
    return '"' + name.replace('"', '\\"') + '"' if any(c in name for c in ',"\n\r') else name


def publish_feed(df: DataFrame, path: str, feed: str) -> None:
    """Replace one feed of the feed table and leave the others; publishing twice changes nothing.

    The feed's own directory is overwritten, so a feed that has become empty leaves no rows.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/feed={feed}")


def land_members(rows: DataFrame, path: str, member: str = "member") -> None:
    """Store unpacked rows by file name; a file that arrives again replaces its former rows."""
    (
        rows.hint("rebalance", member)
        .write.mode("overwrite")
        .partitionBy(member)
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def output_status(spark: SparkSession, outputs: dict[str, tuple[str, str]]) -> DataFrame:
    """Rows and part files of each expected output: {name: (format, path)}.

    An output that does not exist fails the read, as a missing output should.
    """
    def one(name: str, kind: str, path: str) -> DataFrame:
        reader = spark.read.option("header", True) if kind == "csv" else spark.read
        per_file = (
            reader.format(kind).load(path).groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("n"))
        )
        return per_file.agg(
            F.lit(name).alias("output"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.count(F.lit(1)).alias("part_files"),
        )

    parts = [one(name, *spot) for name, spot in outputs.items()]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.withColumn("ready", (F.col("rows") > 0) & (F.col("part_files") > 0))


def require_outputs(status: DataFrame) -> None:
    """An error naming the outputs that are not ready; reads one small row per output."""
    late = [row["output"] for row in status.where(~F.col("ready")).collect()]
    if late:
        raise ValueError(f"outputs not ready: {sorted(late)}")
