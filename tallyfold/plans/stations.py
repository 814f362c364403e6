"""Which stations report almost every day, kept up to date batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.fixed_values import MIN_REPORTED_DAYS
from tallyfold.operators.daybits import WORDS, count_days, day_bits, merge_bits
from tallyfold.sinks.committed import CommittedTable

DAYS_SCHEMA = schemas.columns("station_id string, measured string, " + ", ".join(f"{w} bigint" for w in WORDS) + ", year int")


def days_table(spark: SparkSession, path: str) -> CommittedTable:
    return CommittedTable(spark, path, DAYS_SCHEMA, ["year"])


def fold_days(spark: SparkSession, path: str, rows: DataFrame, batch: str) -> None:
    """Add the reported days of a batch of checked observations to the stored ones.

    Reads the batch and the years it touches, never the observations of earlier batches. A batch that is
    folded in already, in whole or in part, changes nothing.
    """
    table = days_table(spark, path)
    seen = table.version()
    years = [row.year for row in rows.where(F.col("date").isNotNull()).select(F.year("date").alias("year")).distinct().collect()]
    touched = [table.part((str(year),)) for year in years]
    merged = merge_bits(table.read(seen, touched), day_bits(rows))
    table.replace(merged, touched, seen, batch)


def reported_days(spark: SparkSession, path: str) -> DataFrame:
    return count_days(days_table(spark, path).read())


def significant_stations(spark: SparkSession, path: str, min_days: int = MIN_REPORTED_DAYS) -> DataFrame:
    """Pairs that reported on strictly more than ``min_days`` days of the folded batches."""
    return reported_days(spark, path).where(F.col("nb_days") > min_days)
