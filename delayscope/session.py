"""Session settings the operators rely on. Memory and cores belong to the submit command."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Re-plan at run time: merge small shuffle partitions, split skewed join
    # partitions, broadcast a join side only once its real size is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Sketch and map-building aggregates switch to sorting their whole input once
    # a task sees more groups than this. The default (128) is below
    # carriers x hours, so raise it past every bounded grouping used here.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
    # Do not record the Python call site of every column expression; that doubles the
    # time it takes to describe a query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


_LEAST_SPLIT = 128 << 20
_SCAN_TASKS = 200_000
_SHUFFLE_SHARE = 256 << 20


def settings_for_input(input_bytes: int, shuffled_share: float = 0.25) -> dict[str, str]:
    """Split and shuffle sizes for an input of this size, to pass as ``extra``.

    Splits grow with the input once it would take more than two hundred thousand of the
    usual size, so that tasks do not count in the millions. Jobs that move records (duplicate audit, row numbering) start with
    enough shuffle partitions to keep each near a quarter gigabyte; adaptive execution
    merges them again where only aggregates move. ``shuffled_share`` is the part of the
    input's bytes that a job moves.
    """
    partitions = max(200, round(input_bytes * shuffled_share / _SHUFFLE_SHARE))
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(max(_LEAST_SPLIT, input_bytes // _SCAN_TASKS)),
    }


def build_session(
    app_name: str = "delayscope",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
