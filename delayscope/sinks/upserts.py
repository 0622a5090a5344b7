"""Last write wins on a stored series: updates rewrite only the partitions they touch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delayscope.sinks import store
from delayscope.sinks.scratch import discard, scratch_path

BUCKET = "bucket"
BUCKETS = 64


def last_points(points: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """One row per key: that of the highest ``order``, at a tie the larger value."""
    best = F.max(F.struct(F.col(order).alias("_order"), F.col(value).alias("_value"))).alias("_best")
    return points.groupBy(*keys).agg(best).select(*keys, F.col("_best._value").alias(value), F.col("_best._order").alias(order))


def upsert_points(updates: DataFrame, path: str, keys: Sequence[str], value: str, order: str, buckets: int = BUCKETS) -> int:
    """Bring updates (keys, value, order) into the series stored at ``path``.

    Rows are dealt by the hash of their key into ``buckets`` folders. Only folders that
    an update falls into are read, merged and replaced; the files of all others stay as
    they are. ``order`` says which write is the last one (an event id, a time of writing),
    so an update that arrives late changes nothing that is newer, and bringing in the
    same updates twice, as after a failure in the middle, gives the same series. Returns
    the number of folders rewritten, ``buckets`` at most.
    """
    spark = updates.sparkSession
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)
    columns = [*keys, value, order]
    fresh = scratch_path(spark, "updates")
    last_points(updates.select(*columns), keys, value, order).select(*columns, bucket).write.parquet(fresh)
    new = spark.read.parquet(fresh)
    touched = sorted(r[BUCKET] for r in new.select(BUCKET).distinct().collect())
    if touched:
        merged = new.select(*columns)
        if store.exists(spark, path):
            kept = spark.read.parquet(path).where(F.col(BUCKET).isin(touched)).select(*columns)
            merged = last_points(kept.unionByName(merged), keys, value, order)
        (
            merged.select(*columns, bucket).repartition(BUCKET)
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path)
        )
    discard(spark, fresh)
    return len(touched)


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """The stored series without its bucket column."""
    return spark.read.parquet(path).drop(BUCKET)
