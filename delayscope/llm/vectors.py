"""What the operators on vectors share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sound(vectors: DataFrame, vector: str) -> DataFrame:
    """The rows whose vector has components and all of them are finite numbers.

    Of vectors of several lengths those of the most common length stay (the longest of
    these at a tie): others have no inner product with them.
    """
    as_double = F.col(vector).cast("array<double>")
    finite = F.forall(as_double, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = vectors.filter(F.col(vector).isNotNull() & (F.size(vector) > 0)).filter(F.coalesce(finite, F.lit(False)))
    length = dimension(rows, vector)
    return rows.filter(F.size(vector) == length)


def dimension(rows: DataFrame, vector: str) -> int:
    """The most common length of the vectors, 0 where there are none."""
    counts = rows.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    best = counts.agg(F.max(F.struct("n", "d")).alias("best")).first()["best"]
    return best["d"] if best is not None else 0
