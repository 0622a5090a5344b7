"""Incremental ingestion: new CSV files become processed Parquet rows exactly once.

A landing folder can be taken file by file as they come (``ingest_available``), or held back
until it is complete and quiet: ``poll_landing`` writes down what it holds, and a stateful
stream over these notes releases it once it has enough files and nothing has changed for a
number of rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayscope.operators.cleaning import clean_flights
from delayscope.schema import RAW_SCHEMA
from delayscope.sources.archives import CSV_MEMBER
from delayscope.sources.files import landed_files

#: Files a landing folder must hold, and rounds without any change, before it is released.
LEAST_FILES = 4
QUIET_ROUNDS = 3
NOTES = "folder string, round long, files long, bytes long, newest timestamp"
RELEASES = "folder string, round long, files long, bytes long"


def landing_stream(spark: SparkSession, landing: str, files_per_batch: int = 1000) -> DataFrame:
    """Raw records of CSV files as they arrive, cleaned. Other and hidden files are ignored."""
    raw = (
        spark.readStream.schema(RAW_SCHEMA)
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("enforceSchema", False)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(landing)
    )
    return clean_flights(raw.where(F.col("_metadata.file_name").rlike(CSV_MEMBER)))


def ingest_available(spark: SparkSession, landing: str, table: str, checkpoint: str,
                     files_per_batch: int = 1000) -> None:
    """Process every file not yet processed, then stop.

    The checkpoint records which files are done, so a run after a failure, or after more
    files arrived, continues where the last one ended. Nothing is held in state.
    """
    query = (
        landing_stream(spark, landing, files_per_batch)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(table)
    )
    query.awaitTermination()


# --- waiting until a folder is complete and quiet -----------------------------------------


def poll_landing(spark: SparkSession, landing: str, notes: str, number: int) -> None:
    """Round ``number``: append what the folder holds to the notes, reading no content.

    One row of counts whatever the folder holds. A round that is noted twice counts once.
    """
    seen = landed_files(spark, landing).agg(
        F.lit(landing).alias("folder"), F.lit(number).cast("long").alias("round"), F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.max("modificationTime").alias("newest"),
    )
    seen.coalesce(1).write.mode("append").json(notes)


def released_folders(notes: DataFrame, least_files: int = LEAST_FILES, quiet_rounds: int = QUIET_ROUNDS) -> DataFrame:
    """(folder, round, files, bytes) of folders when they become complete and quiet.

    ``notes`` is a stream of polls. The state of a folder is what it held last, in which
    round, and for how many rounds that has not changed; a change, in number, size or
    time of the files, starts the count anew. A folder is released once; when it
    changes after that, it is released again after as many quiet rounds. Rounds older than
    the last one are ignored, so that a poll that is repeated counts once.
    """
    # Defined here so that it travels to the executors by value.
    def watch(key: tuple, frames: Iterator, state) -> Iterator:
        import pandas as pd

        held = tuple(state.get) if state.exists else (-1, -1, -1, "", 0, False)
        number, files, size, newest, quiet, released = held
        rounds = pd.concat(list(frames)).sort_values("round")
        out = []
        for row in rounds.itertuples(index=False):
            if row.round <= number:
                continue
            mark = "" if pd.isna(row.newest) else str(row.newest)
            if (row.files, row.bytes, mark) == (files, size, newest):
                quiet += 1
            else:
                quiet, released = 0, False
            number, files, size, newest = int(row.round), int(row.files), int(row.bytes), mark
            if quiet >= quiet_rounds and files >= least_files and not released:
                released = True
                out.append((key[0], number, files, size))
        state.update((number, files, size, newest, quiet, released))
        yield pd.DataFrame(out, columns=["folder", "round", "files", "bytes"])

    return notes.groupBy("folder").applyInPandasWithState(
        watch, RELEASES, "round long, files long, bytes long, newest string, quiet long, released boolean", "append", "NoTimeout",
    )


def ingest_when_quiet(spark: SparkSession, notes: str, table: str, checkpoint: str,
                      least_files: int = LEAST_FILES, quiet_rounds: int = QUIET_ROUNDS) -> None:
    """Look at the polls not yet looked at and take in the folders they release, then stop.

    Both steps go on from their own checkpoints: the watch on the polls, and per folder
    the record of files already taken, so a run that fails or is repeated adds no row twice.
    """
    polls = spark.readStream.schema(NOTES).json(notes)

    def take(batch: DataFrame, _: int) -> None:
        # One row per released folder.
        for row in batch.select("folder").distinct().collect():
            name = row["folder"].rstrip("/").rsplit("/", 1)[-1]
            ingest_available(batch.sparkSession, row["folder"], f"{table}", f"{checkpoint}/taken-{name}")

    query = (
        released_folders(polls, least_files, quiet_rounds)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", f"{checkpoint}/watch")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
