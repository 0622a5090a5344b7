"""Tables that are replaced in one step: version folders and a manifest that names one of them.

A version is written completely before the manifest is renamed over the former one. Who
reads before that sees the old table, who reads after sees the new one, and a job that
dies in between leaves a folder that no manifest names.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from delayscope.sinks import store

MANIFEST = "current.json"
_PREFIX = "version-"


def current_version(spark: SparkSession, root: str) -> str | None:
    """The folder of the table's current version, None before the first one."""
    text = store.read_text(spark, f"{root}/{MANIFEST}")
    return None if text is None else f"{root}/{json.loads(text)['version']}"


def write_version(df: DataFrame, root: str) -> str:
    """Write the rows as a version that nobody reads yet; returns its name."""
    name = f"{_PREFIX}{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{name}")
    return name


def switch_version(spark: SparkSession, root: str, name: str) -> None:
    """Make a written version the current one; the one before is remembered."""
    text = store.read_text(spark, f"{root}/{MANIFEST}")
    before = [] if text is None else json.loads(text)["history"]
    store.write_text(spark, f"{root}/{MANIFEST}", json.dumps({"version": name, "history": [name, *before]}))


def publish_version(df: DataFrame, root: str) -> str:
    """Replace the table by the rows, all at once; an empty frame leaves an empty table."""
    name = write_version(df, root)
    switch_version(df.sparkSession, root, name)
    return name


def read_version(spark: SparkSession, root: str) -> DataFrame:
    """The table as of now. The frame goes on reading this version after a later switch."""
    path = current_version(spark, root)
    if path is None:
        raise ValueError(f"nothing is published below {root}")
    return spark.read.parquet(path)


def expire_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete versions but the last ``keep`` published ones; returns the names deleted.

    Folders of jobs that died are among them; do not call it while a job is writing.
    """
    text = store.read_text(spark, f"{root}/{MANIFEST}")
    history = [] if text is None else json.loads(text)["history"]
    kept = set(history[: max(keep, 1)])
    gone = [n for n in store.names(spark, root) if n.startswith(_PREFIX) and n not in kept]
    if gone:
        store.write_text(spark, f"{root}/{MANIFEST}", json.dumps({"version": history[0], "history": [n for n in history if n in kept]})) if history else None
    for name in gone:
        store.remove(spark, f"{root}/{name}")
    return gone


def publish_feed_version(df: DataFrame, path: str, feed: str) -> str:
    """Replace one feed of a table of feeds in one step and leave the others."""
    return publish_version(df, f"{path}/{feed}")


def read_feeds(spark: SparkSession, path: str, feeds: list[str]) -> DataFrame:
    """The named feeds as of now, with the name of each in column ``feed``."""
    from pyspark.sql import functions as F

    parts = [read_version(spark, f"{path}/{feed}").withColumn("feed", F.lit(feed)) for feed in feeds]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
