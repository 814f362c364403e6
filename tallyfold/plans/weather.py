"""Weather jobs: selected stations, nearest station per location, the weather fact and its deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.fixed_values import ELEMENTS, MAX_DISTANCE, MIN_REPORTED_DAYS, TERRITORY_PREFIXES
from tallyfold.functions.columns import has_prefix
from tallyfold.operators import reshape
from tallyfold.operators.delta import KEYS, ORDERS, apply_delta, relevant
from tallyfold.operators.joins import attach_total, join_null_safe, keep_known
from tallyfold.operators.latest import lowest_colocated
from tallyfold.operators.nearest import nearest_per_element
from tallyfold.operators.quality import passed_quality, significant_pairs
from tallyfold.session import staging
from tallyfold.sinks.bucketed import BUCKET_KEY, bucket_key, write_bucketed
from tallyfold.sinks.committed import CommittedTable
from tallyfold.sinks.files import write_csv, write_partitioned
from tallyfold.sources.files import read_weather

FACT_PARTITIONS = ("measured", "month")
FACT_SCHEMA = schemas.columns(
    "station_id string, date string, value int, measured string, month string"
)


def convert_raw(spark: SparkSession, source: str | list[str], target: str) -> None:
    """Turn the unsplittable text files into Parquet by element and month, once."""
    rows = read_weather(spark, source).withColumn("month", F.substring("date", 1, 6))
    write_partitioned(rows, target, FACT_PARTITIONS)


def select_stations(
    observations: DataFrame,
    prefixes: Sequence[str] = tuple(TERRITORY_PREFIXES),
    elements: Sequence[str] = tuple(ELEMENTS),
    min_days: int = MIN_REPORTED_DAYS,
) -> DataFrame:
    """(measured, station_id) pairs of the territories that report almost every day."""
    rows = passed_quality(observations).where(
        has_prefix("station_id", prefixes) & F.col("measured").isin(list(elements))
    )
    return significant_pairs(rows, min_days).select("measured", "station_id")


def map_locations(
    locations: DataFrame, stations: DataFrame, selected: DataFrame, cutoff: float | None = MAX_DISTANCE
) -> DataFrame:
    """Nearest selected station per location and element."""
    candidates = lowest_colocated(stations.join(selected, "station_id"))
    return nearest_per_element(
        locations.select("location_id", "latitude", "longitude"),
        candidates.select("station_id", "measured", "latitude", "longitude"),
        cutoff,
    )


def weather_fact(observations: DataFrame, mapping: DataFrame) -> DataFrame:
    """Checked observations of the mapped stations."""
    rows = passed_quality(observations).select(
        "measured", "station_id", "date", F.col("value").try_cast("int").alias("value")
    )
    return keep_known(rows, mapping, ["station_id", "measured"])


def with_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn("month", F.substring("date", 1, 6))


def fact_table(spark: SparkSession, path: str) -> CommittedTable:
    return CommittedTable(spark, path, FACT_SCHEMA, FACT_PARTITIONS)


def write_fact(fact: DataFrame, path: str) -> None:
    fact_table(fact.sparkSession, path).overwrite(with_month(fact))


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """The fact as of now; a delta applied while the frame is in use does not show in it."""
    return fact_table(spark, path).read()


def clean_deltas(deltas: dict[str, DataFrame], selected: DataFrame) -> dict[str, DataFrame]:
    """Relevant delta rows with a numeric value."""
    columns = ["measured", "station_id", "date", "value"]
    return {
        name: relevant(rows, selected, columns).withColumn("value", F.col("value").try_cast("int"))
        for name, rows in deltas.items()
    }


def apply_deltas_to_path(
    spark: SparkSession, path: str, deltas: dict[str, DataFrame], order: Sequence[str] = ORDERS[0]
) -> None:
    """Apply deltas to the stored fact, reading and rewriting only the partitions they touch.

    The result becomes visible at once, when its version is put in place; a run that was cut off before
    leaves the fact as it was, and a run that another one overtook on the same partitions fails with
    :class:`LostCommit`. Applying the same deltas again gives the same fact. Null dates and elements
    have a partition like any other value.
    """
    columns = ["measured", "station_id", "date", "value", "month"]
    marked = reshape.stack_sources({name: with_month(rows).select(*columns) for name, rows in deltas.items()}, "op")
    table = fact_table(spark, path)
    seen = table.version()
    with staging(spark) as stage:
        # Read, checked and filtered once; the deltas serve for pruning and for the result.
        rows = stage(marked, "delta-rows")
        parts = {name: rows.where(F.col("op") == name).drop("op") for name in deltas}
        # Partition names, not data: only the directories that the deltas touch are read.
        touched = [table.part(tuple(row)) for row in rows.select(*FACT_PARTITIONS).distinct().collect()]
        affected = table.read(seen, touched).select(*columns)
        result = apply_delta(affected, parts["delete"], parts["insert"], parts["update"], order, (*KEYS, "month"))
        table.replace(result, touched, seen)


MOST_ELEMENTS = 1000


def _per_element(cases: DataFrame, weather: DataFrame) -> DataFrame:
    """Every case row once per element of the weather; fails should there be more than a thousand of them."""
    listed = F.array_sort(F.collect_set("element"))
    too_many = F.raise_error(F.lit(f"more than {MOST_ELEMENTS} elements")).cast("array<string>")
    elements = weather.select("element").distinct().agg(
        F.when(F.count(F.lit(1)) <= MOST_ELEMENTS, listed).otherwise(too_many).alias("_elements")
    )
    return attach_total(cases, elements).withColumn("element", F.explode("_elements")).drop("_elements")


def cases_with_weather(cases: DataFrame, weather: DataFrame, place: Sequence[str]) -> DataFrame:
    """Every case row once per element, beside the element's observations of its place and day."""
    return join_null_safe(_per_element(cases, weather), weather, [*place, "date", "element"], "left")


def publish_cases_with_weather(cases: DataFrame, weather: DataFrame, place: Sequence[str], target: str) -> None:
    """One directory of CSV files per element."""
    write_csv(cases_with_weather(cases, weather, place), target, ["element"])


def store_weather_by_place(weather: DataFrame, name: str, path: str, place: Sequence[str], buckets: int | None = None) -> None:
    """Keep the observations in buckets by place, day and element, where later joins find them without a shuffle."""
    write_bucketed(weather, name, path, [*place, "date", "element"], buckets)


def cases_with_stored_weather(spark: SparkSession, cases: DataFrame, name: str, place: Sequence[str]) -> DataFrame:
    """Like :func:`cases_with_weather`, over observations stored in buckets: only the cases move to them."""
    keys = [*place, "date", "element"]
    weather = spark.table(name)
    each = _per_element(cases, weather).withColumn(BUCKET_KEY, bucket_key(keys))
    return each.join(weather.drop(*keys), BUCKET_KEY, "left").drop(BUCKET_KEY)
