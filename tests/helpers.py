"""Small flight tables written row by row."""

from delayscope.schema import CAUSES, PROCESSED_COLUMNS, RAW_SCHEMA

FLIGHT_TYPES = {f.name: f.dataType for f in RAW_SCHEMA}


def flights(spark, rows):
    """Processed-layout rows; give only the columns that matter."""
    base = {
        "YEAR": 2025, "MONTH": 1, "DAY_OF_MONTH": 1, "OP_UNIQUE_CARRIER": "AA", "CRS_DEP_TIME": 900,
        "DEP_DELAY": 0.0, "ARR_DELAY": 0.0, "CANCELLED": 0, "DIVERTED": 0, **{c: 0.0 for c in CAUSES},
    }
    kinds = {"CANCELLED": "int", "DIVERTED": "int"}
    ddl = ", ".join(f"{c} {kinds.get(c, FLIGHT_TYPES[c].simpleString())}" for c in PROCESSED_COLUMNS)
    return spark.createDataFrame([tuple({**base, **r}[c] for c in PROCESSED_COLUMNS) for r in rows], ddl)


def raw(spark, rows):
    """27-column rows; columns not given are NULL, flags 0."""
    base = {f.name: None for f in RAW_SCHEMA} | {
        "YEAR": 2025, "MONTH": 1, "DAY_OF_MONTH": 1, "OP_UNIQUE_CARRIER": "AA", "CRS_DEP_TIME": 900,
        "CANCELLED": 0.0, "DIVERTED": 0.0,
    }
    return spark.createDataFrame([tuple({**base, **r}[f.name] for f in RAW_SCHEMA) for r in rows], RAW_SCHEMA)


def causes(*values):
    return dict(zip(CAUSES, values))


def dicts(df):
    return [row.asDict() for row in df.collect()]


def by(df, *keys):
    return {tuple(row[k] for k in keys): row.asDict() for row in df.collect()}
