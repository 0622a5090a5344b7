"""Raw records to the processed fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from delayscope.schema import CAUSES, FLAGS, PROCESSED_COLUMNS


def clean_flights(raw: DataFrame) -> DataFrame:
    """Keep the analysed columns and rows with a carrier; flags to int, unknown causes to 0.

    Delays stay as they are, negative or NULL. One narrow projection over one filter,
    so both reach the scan.
    """
    changed = {flag: f"try_cast({flag} AS int) AS {flag}" for flag in FLAGS}
    changed |= {cause: f"coalesce({cause}, 0.0D) AS {cause}" for cause in CAUSES}
    return raw.where("OP_UNIQUE_CARRIER IS NOT NULL").selectExpr(
        *(changed.get(name, name) for name in PROCESSED_COLUMNS)
    )
