"""Column names and schemas of the flight tables and of every result table."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# --- fixed values: names and types of the published on-time record layout ---

RAW_SCHEMA = StructType([
    StructField("YEAR", IntegerType()),
    StructField("MONTH", IntegerType()),
    StructField("DAY_OF_MONTH", IntegerType()),
    StructField("OP_UNIQUE_CARRIER", StringType()),
    StructField("OP_CARRIER_FL_NUM", IntegerType()),
    StructField("ORIGIN_AIRPORT_ID", IntegerType()),
    StructField("ORIGIN_CITY_MARKET_ID", IntegerType()),
    StructField("ORIGIN_STATE_ABR", StringType()),
    StructField("DEST_AIRPORT_ID", IntegerType()),
    StructField("DEST_CITY_MARKET_ID", IntegerType()),
    StructField("DEST_STATE_ABR", StringType()),
    StructField("CRS_DEP_TIME", IntegerType()),
    StructField("DEP_TIME", DoubleType()),
    StructField("DEP_DELAY", DoubleType()),
    StructField("CRS_ARR_TIME", IntegerType()),
    StructField("ARR_TIME", DoubleType()),
    StructField("ARR_DELAY", DoubleType()),
    StructField("CANCELLED", DoubleType()),
    StructField("CANCELLATION_CODE", StringType()),
    StructField("DIVERTED", DoubleType()),
    StructField("ACTUAL_ELAPSED_TIME", DoubleType()),
    StructField("DISTANCE", DoubleType()),
    StructField("CARRIER_DELAY", DoubleType()),
    StructField("WEATHER_DELAY", DoubleType()),
    StructField("NAS_DELAY", DoubleType()),
    StructField("SECURITY_DELAY", DoubleType()),
    StructField("LATE_AIRCRAFT_DELAY", DoubleType()),
])

CAUSES = ["CARRIER_DELAY", "WEATHER_DELAY", "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY"]

FLAGS = ["CANCELLED", "DIVERTED"]

PROCESSED_COLUMNS = [
    "YEAR", "MONTH", "DAY_OF_MONTH", "OP_UNIQUE_CARRIER", "CRS_DEP_TIME",
    "DEP_DELAY", "ARR_DELAY", *FLAGS, *CAUSES,
]

FLIGHT_KEY = [
    "YEAR", "MONTH", "DAY_OF_MONTH", "OP_UNIQUE_CARRIER", "OP_CARRIER_FL_NUM",
    "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "CRS_DEP_TIME",
]

RAW_FILE_PATTERN = "20250*_T_ONTIME_REPORTING.csv"

# --- end of fixed values ---

# Columns a by-name read converts from text; the rest stay text.
BY_NAME_WHOLE = ["YEAR", "MONTH", "DAY_OF_MONTH", "CRS_DEP_TIME"]
BY_NAME_NUMBER = ["DEP_DELAY", "ARR_DELAY", *FLAGS, *CAUSES]

# Result tables: key columns, then measures.
MONTHLY_KEYS = ["month", "airline"]
MONTHLY_COUNTS = ["total_flights", "cancelled_flights", "non_cancelled_flights"]
MONTHLY_MEASURES = [
    *(f"{side}_delay_{stat}" for side in ("dep", "arr") for stat in ("mean", "min", "max")),
    "cancellation_rate",
]
CARRIER_KEYS = ["carrier"]
CAUSE_MEANS = [f"{cause.lower()}_mean" for cause in CAUSES]
CARRIER_MEASURES = ["num_flights", "arrdelay_mean", *CAUSE_MEANS]
HOURLY_KEYS = ["airline", "hour"]
PERCENTILE_COLUMNS = ["p25", "p50", "p75", "p90"]
HOURLY_MEASURES = ["num_flights", *PERCENTILE_COLUMNS]
EXTREME_KEYS = ["airline"]
EXTREME_MEASURES = ["min_delay", "max_delay"]
