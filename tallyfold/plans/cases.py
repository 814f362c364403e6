"""Case-count jobs on stored tables: the first load and the recurring batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold import schemas
from tallyfold.operators.incremental import attach_location_id, daily_of, fresh_days, full_load, next_snapshot
from tallyfold.operators.joins import split_matched
from tallyfold.session import staging
from tallyfold.sinks.files import read_version, write_version

DAILY_SCHEMA = T.StructType([*schemas.CASES_DAILY, T.StructField("batch", T.LongType())])


def _write_daily(daily: DataFrame, path: str, batch: int) -> None:
    """Each batch owns one partition: writing it again replaces it."""
    (
        daily.select(*schemas.CASES_DAILY.names)
        .withColumn("batch", F.lit(batch).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch")
        .parquet(path)
    )


def first_load(cumulated: DataFrame, locations: DataFrame, daily_path: str, snapshot_path: str) -> DataFrame:
    """Write batch 0 and the first snapshot; returns the places that matched no location."""
    result = full_load(cumulated, locations)
    _write_daily(result.daily, daily_path, 0)
    write_version(result.snapshot, snapshot_path, 0)
    return result.unmatched


def next_batch(
    spark: SparkSession, batch: DataFrame, locations: DataFrame, daily_path: str, snapshot_path: str, number: int
) -> DataFrame:
    """Load batch ``number`` (from 1); running the same number again gives the same tables."""
    snapshot = read_version(spark, snapshot_path, schemas.CASES_SNAPSHOT, before=number)
    if snapshot is None:
        raise ValueError(f"no finished snapshot before batch {number} in {snapshot_path}")
    known, unmatched = split_matched(attach_location_id(batch, locations), "location_id")
    with staging(spark) as stage:
        fresh = stage(fresh_days(known, snapshot), "fresh-days")
        _write_daily(daily_of(fresh, snapshot), daily_path, number)
        write_version(next_snapshot(snapshot, fresh), snapshot_path, number)
    return unmatched


def read_daily(spark: SparkSession, daily_path: str) -> DataFrame:
    return spark.read.schema(DAILY_SCHEMA).parquet(daily_path)
