"""The location table: every reporting place with coordinates and an id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyfold import schemas
from tallyfold.functions.columns import fips_text
from tallyfold.operators.identity import new_ids
from tallyfold.operators.joins import join_null_safe
from tallyfold.operators.locations import (
    PLACE,
    distinct_locations,
    place_overrides,
    rename_states,
    resolve_locations,
    territory_overrides,
    with_coordinates,
    with_location_id,
)
from tallyfold.session import staging
from tallyfold.sinks.committed import CommittedTable
from tallyfold.sinks.files import write_partitioned
from tallyfold.sources.files import read_cases, read_parquet, read_state_coordinates
from tallyfold.sources.text import parse_gazetteer, read_lines


def build_locations(cases: DataFrame, gazetteer: DataFrame, states: DataFrame) -> DataFrame:
    """Places of the case table with coordinates; those that resolve to none are left out."""
    spark = cases.sparkSession
    reported = distinct_locations(cases.withColumn("fips", fips_text("fips")))
    resolved = resolve_locations(
        reported, gazetteer, rename_states(states), territory_overrides(spark), place_overrides(spark)
    )
    return with_location_id(with_coordinates(resolved).drop("resolved_by"))


def publish_locations(spark: SparkSession, cases_path: str, gazetteer_path: str, states_path: str, target: str) -> None:
    """Write the location table by state from the landed files."""
    locations = build_locations(
        read_cases(spark, cases_path),
        parse_gazetteer(read_lines(spark, gazetteer_path)),
        read_state_coordinates(spark, states_path),
    )
    write_partitioned(locations, target, ["state"])


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.LOCATIONS)


ID_SCHEMA = schemas.columns("state string, county string, fips string, location_id bigint")


def location_ids(spark: SparkSession, path: str) -> CommittedTable:
    """The stored dictionary of places and their ids."""
    return CommittedTable(spark, path, ID_SCHEMA)


def add_location_ids(spark: SparkSession, path: str, places: DataFrame, batch: str) -> None:
    """Give an id to every place that the dictionary does not list; ids once given stay.

    Two places with one hash get different ids. Of two runs from one version the second fails and can
    be run again.
    """
    table = location_ids(spark, path)
    seen = table.version()
    with staging(spark) as stage:
        table.append(new_ids(places, table.read(seen), PLACE, "location_id", stage=stage), batch, seen)


def with_stored_id(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Rows with the id of their place, null where the dictionary does not list it."""
    return join_null_safe(rows, location_ids(spark, path).read(), PLACE, "left")
