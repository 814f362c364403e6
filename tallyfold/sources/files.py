"""Typed scans of delimited, JSON and Parquet inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.utils import AnalysisException

from tallyfold import schemas
from tallyfold.functions.columns import cast_all

DELTA_OPERATIONS = ("delete", "insert", "update")


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType, header: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("header", header).csv(path)


def read_text_then_cast(spark: SparkSession, path: str, types: StructType, header: bool = True) -> DataFrame:
    """All columns as text, then cast; a value that does not parse becomes null."""
    as_text = StructType([StructField(f.name, StringType()) for f in types])
    rows = read_csv(spark, path, as_text, header)
    return cast_all(rows, {f.name: f.dataType.simpleString() for f in types})


def read_weather(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Observation files, headerless, possibly gzipped.

    A gzip file is read by one task: convert it once with ``plans.weather.convert_raw`` and read that.
    """
    return read_csv(spark, path, schemas.WEATHER_RAW, header=False)


def read_cases(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, schemas.CASES_CUMULATED)


def read_surveillance(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv(spark, path, schemas.SURVEILLANCE)


def read_state_coordinates(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.STATE_COORDINATES)


def read_state_abbreviations(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.STATE_ABBREVIATIONS)


def read_closest_stations(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.CLOSEST_STATIONS)


def read_census(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.CENSUS)


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One JSON array over several lines per file; each file is one task, so prefer JSON lines."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def rows_frame(spark: SparkSession, records: Sequence[dict], schema: StructType) -> DataFrame:
    """Frame of records already in memory, such as one page of a query result."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in records], schema)


def parse_json_column(rows: DataFrame, column: str, schema: StructType) -> DataFrame:
    """The fields of a JSON text column beside the other columns."""
    parsed = rows.withColumn("_json", F.from_json(column, schema))
    return parsed.select(*[c for c in rows.columns if c != column], "_json.*")


def read_parquet(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    """Parquet data set. With a schema, partition values keep their type (a date stays text)."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_partition(spark: SparkSession, path: str, schema: StructType, **values: str) -> DataFrame:
    """Rows of one partition; the filter prunes directories, and an absent partition has no rows."""
    rows = read_parquet(spark, path, schema)
    for name, value in values.items():
        rows = rows.where(F.col(name) == value)
    return rows


def read_deltas(spark: SparkSession, directory: str, header: bool = False) -> dict[str, DataFrame]:
    """delete, insert and update files of a delta directory; an absent file is an empty frame."""
    deltas = {}
    for operation in DELTA_OPERATIONS:
        try:
            deltas[operation] = read_csv(spark, f"{directory}/{operation}.csv", schemas.WEATHER_RAW, header)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            deltas[operation] = empty_like(spark, schemas.WEATHER_RAW)
    return deltas


def empty_like(spark: SparkSession, structure: StructType | DataFrame) -> DataFrame:
    schema = structure.schema if isinstance(structure, DataFrame) else structure
    return spark.createDataFrame([], schema)
