"""Readers of raw, processed and result files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from delayscope.functions import number, whole
from delayscope.schema import BY_NAME_NUMBER, BY_NAME_WHOLE, RAW_SCHEMA
from delayscope.sinks import store
from delayscope.sources.contract import require_columns

Paths = str | Sequence[str]


def read_raw(spark: SparkSession, path: Paths, schema: StructType = RAW_SCHEMA,
             name_pattern: str | None = None) -> DataFrame:
    """CSV under a path, list or glob with the fixed 27-column layout; empty text is NULL.

    A header that does not match the layout is an error: binding by position would move
    values into the wrong columns silently.
    """
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("nullValue", "")
        .option("emptyValue", "")
        .option("enforceSchema", False)
    )
    if name_pattern:
        reader = reader.option("pathGlobFilter", name_pattern)
    return reader.csv(path if isinstance(path, str) else list(path))


def headers(spark: SparkSession, path: Paths) -> dict[str, list[str]]:
    """The header lines of the CSV files below a path, list or glob, each with its files.

    Files are listed as Spark lists them, and the first line of each is read: one short
    read per file, nothing of its content.
    """
    listed = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path)).select("path", "length")
    found: dict[str, list[str]] = {}
    for row in listed.where("length > 0").orderBy("path").toLocalIterator():
        found.setdefault(store.first_line(spark, row["path"]), []).append(row["path"])
    return found


def read_by_name(spark: SparkSession, path: Paths) -> DataFrame:
    """CSV bound by header, all columns text, the analysed ones converted.

    Files may differ in their columns and the order of these: they are grouped by header
    line, every group is bound to its own, and the groups are stacked by name. Columns that a
    file lacks are NULL; the analysed ones must be in one of them.
    """
    def one(files: list[str]) -> DataFrame:
        return spark.read.option("header", True).option("nullValue", "").option("enforceSchema", False).csv(files)

    groups = [one(files) for files in headers(spark, path).values()]
    if not groups:
        raise ValueError(f"no CSV files below {path}")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)
    require_columns(stacked, [*BY_NAME_WHOLE, *BY_NAME_NUMBER], str(path))
    return convert_by_name(stacked)


def convert_by_name(text: DataFrame) -> DataFrame:
    """The by-name conversions on a frame of text columns."""
    return text.withColumns(
        {name: whole(name).try_cast("int") for name in BY_NAME_WHOLE} | {name: number(name) for name in BY_NAME_NUMBER}
    )


def convert_raw(text: DataFrame) -> DataFrame:
    """Text columns of the 27-column layout with the types of that layout."""
    convert = {"integer": lambda name: whole(name).try_cast("int"), "double": number, "string": F.col}
    return text.select(*(convert[f.dataType.typeName()](f.name).alias(f.name) for f in RAW_SCHEMA))


def read_processed(spark: SparkSession, path: Paths, columns: Sequence[str] | None = None) -> DataFrame:
    """Processed Parquet, narrowed to the named columns."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df if columns is None else df.select(*columns)


def read_result(spark: SparkSession, path: Paths) -> DataFrame:
    """A stored CSV result as text, with NULL shown as the empty string."""
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .csv(path if isinstance(path, str) else list(path))
        .na.fill("")
    )


def with_source_file(df: DataFrame, name: str = "source_file") -> DataFrame:
    """Adds the name of the file each row came from; call it right after a reader."""
    return df.select("*", F.col("_metadata.file_name").alias(name))


def landed_files(spark: SparkSession, path: Paths, name_pattern: str = r"^[^.].*\.csv$") -> DataFrame:
    """Name, size and time of the files below a path whose name matches; contents stay unread."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(
        path if isinstance(path, str) else list(path)
    )
    name = F.element_at(F.split("path", "/"), -1)
    return listed.select(name.alias("file_name"), "path", "length", "modificationTime").where(
        name.rlike(name_pattern)
    )


def require_landed(spark: SparkSession, path: Paths, at_least: int = 4) -> int:
    """The number of landed CSV files, or an error while there are too few."""
    found = landed_files(spark, path).count()
    if found < at_least:
        raise ValueError(f"{found} CSV files below {path}, expected at least {at_least}")
    return found
