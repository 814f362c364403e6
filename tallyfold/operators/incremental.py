"""Maintenance of the daily case table from overlapping batches of cumulated counts."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.delta import one_per_key
from tallyfold.operators.joins import join_null_safe, split_matched
from tallyfold.operators.latest import snapshot as merge_snapshot
from tallyfold.operators.timeseries import daily_increments, month_of

PLACE = ["state", "county", "fips"]
SNAPSHOT_COLUMNS = ["date", "location_id", "fips", "county", "state", "deaths", "cases"]
DAILY_COLUMNS = ["date", "location_id", "daily_cases", "daily_deaths"]


class BatchResult(NamedTuple):
    """``passed_over`` holds the matched rows of days that are loaded already; where these may be revised,
    load batches with ``plans.ledger`` instead."""

    daily: DataFrame
    snapshot: DataFrame
    unmatched: DataFrame
    passed_over: DataFrame | None = None


def attach_location_id(rows: DataFrame, locations: DataFrame) -> DataFrame:
    """Add ``location_id``; a place without county code matches one without, unknown places get null."""
    return join_null_safe(rows, locations.select(*PLACE, "location_id"), PLACE, "left")


def carry_in(recent: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Recent rows plus the snapshot row of every location whose recent rows all lie after it."""
    starts = recent.groupBy("location_id").agg(F.min("date").alias("_start"))
    baseline = (
        snapshot.join(starts, "location_id").where(F.col("date") < F.col("_start")).select(*SNAPSHOT_COLUMNS)
    )
    return recent.unionByName(baseline, allowMissingColumns=True)


def drop_loaded(recent: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Rows after their location's snapshot date; locations without a snapshot keep all rows."""
    last = snapshot.groupBy("location_id").agg(F.max("date").alias("_last"))
    rows = recent.join(last, "location_id", "left")
    return rows.where(F.col("_last").isNull() | (F.col("date") > F.col("_last"))).drop("_last")


def loaded_days(recent: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The rows that :func:`drop_loaded` leaves out."""
    last = snapshot.groupBy("location_id").agg(F.max("date").alias("_last"))
    return recent.join(last, "location_id").where(F.col("date") <= F.col("_last")).drop("_last")


def unique_days(rows: DataFrame) -> DataFrame:
    """One row per location and day: a day delivered again with the same counts counts once, with
    others it fails the job."""
    return one_per_key(rows.select(*SNAPSHOT_COLUMNS), ["location_id", "date"], what="batch").select(*SNAPSHOT_COLUMNS)


def fresh_days(known: DataFrame, snapshot: DataFrame) -> DataFrame:
    """The batch's days after each location's snapshot, one row per day."""
    return unique_days(drop_loaded(known, snapshot))


def daily_of(fresh: DataFrame, snapshot: DataFrame, first: str = "null") -> DataFrame:
    """Increments of the fresh days; the row before a location's first is its snapshot row."""
    series = carry_in(fresh.withColumn("_new", F.lit(True)), snapshot)
    daily = daily_increments(series, ["location_id"], ["cases", "deaths"], first=first, block=month_of("date"))
    return daily.where(F.col("_new")).select(*DAILY_COLUMNS)


def next_snapshot(snapshot: DataFrame, fresh: DataFrame) -> DataFrame:
    return merge_snapshot(snapshot, fresh).select(*SNAPSHOT_COLUMNS)


def load_batch(snapshot: DataFrame, batch: DataFrame, locations: DataFrame, first: str = "null") -> BatchResult:
    """New daily rows, the next snapshot and the places that matched no location.

    Rows already loaded go first, so the row before a location's first new day is always its
    snapshot row. Folding any date-ordered split of a series gives what one load gives. The stored job
    writes the fresh days once and derives both results from them.
    """
    known, unmatched = split_matched(attach_location_id(batch, locations), "location_id")
    fresh = fresh_days(known, snapshot)
    passed_over = loaded_days(known, snapshot)
    return BatchResult(daily_of(fresh, snapshot, first), next_snapshot(snapshot, fresh), unmatched, passed_over)


def full_load(cumulated: DataFrame, locations: DataFrame, first: str = "zero") -> BatchResult:
    """Daily rows and snapshot of the complete cumulated table."""
    known, unmatched = split_matched(attach_location_id(cumulated, locations), "location_id")
    # Increments check and collapse repeated days themselves; the snapshot collapses identical rows.
    daily = daily_increments(
        known, ["location_id"], ["cases", "deaths"], first=first, block=month_of("date")
    )
    return BatchResult(
        daily.select(*DAILY_COLUMNS), merge_snapshot(None, known.select(*SNAPSHOT_COLUMNS)), unmatched
    )
