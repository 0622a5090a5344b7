"""First rows of each group, and row numbers, without collecting a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_k(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int,
            position: str = "position") -> DataFrame:
    """The first k rows of each group with their 1-based position.

    A row-number test against a literal lets the optimizer cut every task's output to k
    rows per group before the shuffle, so the final task of a hot group sorts k rows per
    task instead of the group.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(position, F.row_number().over(window)).where(F.col(position) <= k)


def number_rows(df: DataFrame, keys: Sequence[str], coarse: Sequence[Column], fine: Sequence[str | Column],
                position: str = "position") -> DataFrame:
    """1-based position of every row of a group, in the order (coarse..., fine...).

    ``coarse`` must be a leading part of the order that cuts each group into buckets of
    bounded size, such as an id divided by a bucket width. Rows are numbered inside
    their bucket and shifted by the size of the buckets before it, so a group's rows
    stay spread over tasks; only its bucket counts come together.
    """
    buckets = [f"_bucket_{i}" for i in range(len(coarse))]
    tagged = df.withColumns(dict(zip(buckets, coarse)))
    before = Window.partitionBy(*keys).orderBy(*buckets).rowsBetween(Window.unboundedPreceding, -1)
    # A struct as key: equal also where a part of it is NULL, and the join and the
    # numbering below need the same partitioning of the rows, hence one shuffle.
    spot = F.struct(*keys, *buckets).alias("_spot")
    shifts = (
        tagged.groupBy(*keys, *buckets)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(spot, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    )
    inside = Window.partitionBy("_spot").orderBy(*fine)
    joined = tagged.select(*df.columns, spot).join(shifts, "_spot")
    numbered = joined.withColumn(position, (F.col("_shift") + F.row_number().over(inside)).cast("long"))
    return numbered.select(*df.columns, position)
