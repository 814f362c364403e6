"""Population-group jobs: full load and the rows added since the last date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyfold import schemas
from tallyfold.operators.quality import require_rows
from tallyfold.operators.star import clean_groups, population_dimensions, population_fact
from tallyfold.operators.timeseries import last_loaded, newer_than
from tallyfold.sinks.committed import CommittedTable
from tallyfold.sinks.files import write_flat
from tallyfold.sources.files import read_json_array

DATE = "cdc_case_earliest_dt"


def fact_table(spark: SparkSession, path: str) -> CommittedTable:
    return CommittedTable(spark, path, schemas.POPULATION_FACT)


def full_load(spark: SparkSession, groups_path: str, fact_path: str, dimensions_path: str) -> None:
    """Write the fact and its three dimensions; rows with an unlisted label keep a null id."""
    dimensions = population_dimensions(spark)
    groups = clean_groups(read_json_array(spark, groups_path, schemas.POPULATION_GROUPS))
    fact_table(spark, fact_path).overwrite(population_fact(groups, dimensions))
    for dim in dimensions:
        write_flat(dim.table, f"{dimensions_path}/{dim.key.removesuffix('_id')}")


def append_new(spark: SparkSession, groups: DataFrame, fact_path: str) -> None:
    """Append the groups dated after the fact's last date; fails when there are none.

    The rows are a batch named after that date: of two runs that started from it, one adds its rows.
    """
    table = fact_table(spark, fact_path)
    last = last_loaded(table.read(), DATE)
    fresh = newer_than(clean_groups(groups), last, DATE)
    fresh = require_rows(fresh, "no group counts after the last loaded date")
    table.append(population_fact(fresh, population_dimensions(spark), "inner"), f"after {last.first()[0]}")
