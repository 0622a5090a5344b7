"""What an input must provide before it is used."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def require_columns(df: DataFrame, columns: Iterable[str], label: str = "input") -> DataFrame:
    """The frame itself, or an error naming the columns it lacks."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{label} lacks columns {missing}; it has {df.columns}")
    return df


def require_rows(df: DataFrame, label: str = "input") -> DataFrame:
    """The frame itself, or an error when it is empty. Reads at most one row."""
    if df.isEmpty():
        raise ValueError(f"{label} has no rows")
    return df
