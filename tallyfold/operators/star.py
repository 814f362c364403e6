"""Population-group star schema: three dimensions and one fact."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold import schemas
from tallyfold.fixed_values import AGE_GROUPS, RACES, SEXES
from tallyfold.functions.columns import before_comma, iso_date
from tallyfold.operators.timeseries import last_loaded, newer_than


class Dimension(NamedTuple):
    """A lookup table: fact column ``label`` is replaced by ``key``."""

    table: DataFrame
    label: str
    key: str


def population_dimensions(spark: SparkSession) -> list[Dimension]:
    return [
        Dimension(spark.createDataFrame(SEXES, schemas.SEX_DIMENSION), "sex", "sex_id"),
        Dimension(spark.createDataFrame(AGE_GROUPS, schemas.AGE_DIMENSION), "age_group", "age_group_id"),
        Dimension(spark.createDataFrame(RACES, schemas.RACE_DIMENSION), "race", "race_ethnicity_id"),
    ]


def attach_dimensions(rows: DataFrame, dimensions: Sequence[Dimension], how: str = "left") -> DataFrame:
    """Replace labels by ids. ``left`` keeps rows with an unlisted label (null id), ``inner`` drops them."""
    for dim in dimensions:
        rows = rows.join(dim.table.select(dim.label, dim.key), dim.label, how).drop(dim.label)
    return rows


def group_counts(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Case lines counted per group, as the source delivers them."""
    return lines.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"))


def clean_groups(raw: DataFrame) -> DataFrame:
    """Typed group counts; the race label loses the part after its comma."""
    return raw.select(
        iso_date("cdc_case_earliest_dt").alias("cdc_case_earliest_dt"),
        "sex",
        "age_group",
        before_comma("race_ethnicity_combined").alias("race"),
        F.col("count").try_cast("bigint").alias("count"),
    )


def population_fact(groups: DataFrame, dimensions: Sequence[Dimension], how: str = "left") -> DataFrame:
    """One row per (date, dimension ids); labels dropped on the way are summed up."""
    return sum_fact(attach_dimensions(groups, dimensions, how), ["cdc_case_earliest_dt", *[d.key for d in dimensions]])


def sum_fact(rows: DataFrame, keys: Sequence[str], count: str = "count") -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum(count).alias(count))


def uncovered(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Number of fact rows per dimension whose label is not listed."""
    missing = [F.count_if(F.col(d.key).isNull()).alias(d.key) for d in dimensions]
    return fact.agg(*missing)


def incremental_population_rows(
    fact: DataFrame,
    lines: DataFrame,
    dimensions: Sequence[Dimension],
    columns: Sequence[str],
    date: str = "cdc_case_earliest_dt",
    how: str = "inner",
) -> DataFrame:
    """Fact rows to append: lines after the fact's last date, grouped, with ids."""
    fresh = newer_than(lines, last_loaded(fact, date), date)
    counted = group_counts(fresh, [date, *columns])
    return sum_fact(attach_dimensions(counted, dimensions, how), [date, *[d.key for d in dimensions]])
