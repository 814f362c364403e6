"""Checks on tables; each is one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.fixed_values import MIN_REPORTED_DAYS


def passed_quality(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("quality_flag").isNull())


def reporting_days(rows: DataFrame, keys: Sequence[str] = ("station_id", "measured"), date: str = "date") -> DataFrame:
    """Distinct days on which each pair reported.

    Two groupings instead of a distinct count: the first is by (pair, day), so a hot pair spreads
    over its days and the second sees at most one row per day and task.
    """
    days = rows.select(*keys, date).where(F.col(date).isNotNull()).distinct()
    return days.groupBy(*keys).agg(F.count(F.lit(1)).alias("nb_days"))


def significant_pairs(
    rows: DataFrame,
    min_days: int = MIN_REPORTED_DAYS,
    keys: Sequence[str] = ("station_id", "measured"),
    date: str = "date",
) -> DataFrame:
    """Pairs that reported on strictly more than ``min_days`` days."""
    return reporting_days(rows, keys, date).where(F.col("nb_days") > min_days)


def quality_report(rows: DataFrame, keys: Sequence[str], checks: dict[str, Column]) -> DataFrame:
    """One row: rows, keys that repeat, rows in repeated keys, and the rows failing each check.

    One grouping by key serves them all, so the table is read and shuffled once.
    """
    per_key = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(c).alias(name) for name, c in checks.items()]
    )
    repeated = F.col("_n") > 1
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(repeated).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeated, F.col("_n"))), F.lit(0)).alias("rows_in_repeated_keys"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in checks],
    )


def expected_cardinality(mapping: DataFrame, locations: DataFrame, elements: DataFrame) -> DataFrame:
    """One row: mapped pairs beside locations x elements."""
    found = mapping.select("location_id", "measured").distinct().agg(F.count(F.lit(1)).alias("mapped"))
    places = locations.agg(F.count(F.lit(1)).alias("_places"))
    kinds = elements.select("measured").distinct().agg(F.count(F.lit(1)).alias("_kinds"))
    return found.crossJoin(F.broadcast(places)).crossJoin(F.broadcast(kinds)).select(
        "mapped", (F.col("_places") * F.col("_kinds")).alias("expected")
    )


def reconciles(groups: DataFrame, lines: DataFrame, count: str = "count") -> DataFrame:
    """One row: sum of the group counts, number of source lines, and whether they agree."""
    counted = groups.agg(F.coalesce(F.sum(count), F.lit(0)).alias("grouped"))
    source = lines.agg(F.count(F.lit(1)).alias("lines"))
    return counted.crossJoin(F.broadcast(source)).withColumn("agrees", F.col("grouped") == F.col("lines"))


def flag_domain(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency of every value of the flag columns, null included, in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("flag"), F.col(c).cast("string").alias("value")) for c in columns])
    return rows.select(F.inline(pairs)).groupBy("flag", "value").agg(F.count(F.lit(1)).alias("count"))


def holds_separator(rows: DataFrame, column: str, separator: str = ",") -> DataFrame:
    """How many values contain the separator and how many do not."""
    return rows.groupBy((F.instr(F.col(column), separator) > 0).alias("has_separator")).agg(
        F.count(F.lit(1)).alias("count")
    )


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """The same frame; fails at once when it is empty. Reads no more than one row."""
    if df.isEmpty():
        raise ValueError(message)
    return df
