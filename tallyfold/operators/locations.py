"""Coordinates of reporting locations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.fixed_values import PLACE_COORDINATES, STATE_RENAMES, TERRITORY_COORDINATES, UNKNOWN_COUNTY
from tallyfold.functions.columns import both_present, surrogate_id
from tallyfold.operators.joins import one_row_per_key

PLACE = ["state", "county", "fips"]


def territory_overrides(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TERRITORY_COORDINATES, "state string, latitude double, longitude double")


def place_overrides(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PLACE_COORDINATES, "county string, latitude double, longitude double")


def rename_states(states: DataFrame, renames=tuple(STATE_RENAMES)) -> DataFrame:
    name = F.col("state")
    for old, new in renames:
        name = F.when(F.col("state") == old, new).otherwise(name)
    return states.withColumn("state", name)


def distinct_locations(cases: DataFrame) -> DataFrame:
    return cases.select(*PLACE).distinct()


def _found(df: DataFrame, key: str, prefix: str) -> DataFrame:
    return one_row_per_key(df.select(key, "latitude", "longitude"), [key]).select(
        F.col(key).alias(f"_{prefix}_key"),
        F.col("latitude").alias(f"_{prefix}_lat"),
        F.col("longitude").alias(f"_{prefix}_lon"),
    )


def resolve_locations(
    locations: DataFrame, gazetteer: DataFrame, states: DataFrame, territories: DataFrame, places: DataFrame
) -> DataFrame:
    """Add latitude, longitude and ``resolved_by`` to each location, null where nothing applies.

    County code first; without a match, an unknown county takes its state's coordinates (a listed
    territory wins) and any other place its listed coordinates. One pass of left joins: the lookup
    tables are small, and a location is never read twice.
    """
    unknown = F.col("county") == UNKNOWN_COUNTY
    rows = locations.join(_found(gazetteer, "fips", "gaz"), F.col("fips") == F.col("_gaz_key"), "left")
    open_row = F.col("_gaz_key").isNull()
    rows = (
        rows.join(_found(states, "state", "state"), open_row & unknown & (F.col("state") == F.col("_state_key")), "left")
        .join(_found(territories, "state", "terr"), open_row & unknown & (F.col("state") == F.col("_terr_key")), "left")
        .join(_found(places, "county", "place"), open_row & ~unknown & (F.col("county") == F.col("_place_key")), "left")
    )
    order = ("gaz", "terr", "state", "place")
    labels = {"gaz": "fips", "terr": "territory", "state": "state", "place": "place"}
    source = F.coalesce(*[F.when(F.col(f"_{p}_key").isNotNull(), labels[p]) for p in order])
    return rows.select(
        *locations.columns,
        F.coalesce(*[F.col(f"_{p}_lat") for p in order]).alias("latitude"),
        F.coalesce(*[F.col(f"_{p}_lon") for p in order]).alias("longitude"),
        source.alias("resolved_by"),
    )


def with_coordinates(locations: DataFrame) -> DataFrame:
    return locations.where(both_present("latitude", "longitude"))


def with_location_id(locations: DataFrame) -> DataFrame:
    """Add the id; the job fails should two places ever share one."""
    return one_row_per_key(locations.withColumn("location_id", surrogate_id(*PLACE)), ["location_id"])
