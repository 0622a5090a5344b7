"""Helpers the training-data operators share."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delayscope.sinks import scratch
from delayscope.sinks.scratch import scratch_path

#: The white space that separates words, as the contracts state it.
WHITE = " \t\n\v\f\r"


#: Where stored tables are, as long as someone holds them.
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    Cuts the lineage: a later lost executor costs a re-read, not a recomputation, and
    what is used twice is computed once.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def discard(*tables: DataFrame | None) -> None:
    """Delete stored tables that nothing will read again; others are left alone."""
    for table in tables:
        path = _paths.pop(table, None) if table is not None else None
        if path is not None:
            scratch.discard(table.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Let the shuffle files of finished steps go: Spark deletes them once the driver has forgotten their plans."""
    gc.collect()
    spark._jvm.System.gc()


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each lengthened until no column is called so, whatever its case."""
    taken = {c.lower() for c in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def stored_columns(df: DataFrame, label: str, buckets: Column) -> DataFrame:
    """Like ``stored``, dealt evenly over tasks by the given expression first."""
    return stored(df.repartition(buckets), label)


def few_rows(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches a few rows at a time: a batch can hold ten thousand whole texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_of(column: str = "text") -> Column:
    """A text column in which null is the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
