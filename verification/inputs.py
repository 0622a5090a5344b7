"""The given tables as the frames the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from delayscope.operators.cleaning import clean_flights
from delayscope.schema import CAUSES, RAW_SCHEMA
from verification import views

# View column -> layout column, where the names differ.
RENAMED = {
    "YEAR": "yr",
    "MONTH": "mon",
    "DAY_OF_MONTH": "dom",
    "OP_UNIQUE_CARRIER": "carrier",
    "OP_CARRIER_FL_NUM": "flight_num",
    "ORIGIN_AIRPORT_ID": "origin_id",
    "DEST_AIRPORT_ID": "dest_id",
}
SAME_NAME = ["CRS_DEP_TIME", "DEP_DELAY", "ARR_DELAY", "CANCELLED", "DIVERTED", *CAUSES]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, sql: str, source: str) -> DataFrame:
    return spark.sql(sql.replace(f"FROM {source}", f"FROM {{{source}}}"), **{source: table(spark, sf_dir, source)})


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 27-column raw layout; columns the view does not derive are NULL."""
    known = {**RENAMED, **{name: name.lower() for name in SAME_NAME}}
    columns = ", ".join(
        f"CAST({known.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in RAW_SCHEMA
    )
    return _view(spark, sf_dir, f"SELECT {columns} FROM ({views.FLIGHTS_RAW}) v", "lineitem")


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 14-column processed layout."""
    return clean_flights(raw_flights(spark, sf_dir))


def tlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, views.TLOG, "events")


def phase_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, views.PHASE_LOG, "events")


def text_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, views.TEXT_LOG, "events")
