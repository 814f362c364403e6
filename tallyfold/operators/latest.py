"""First and latest row of each key.

A rank compared with 1 is cut to the leading rows inside each map task before the shuffle; the
aggregate forms combine partially. Neither ever collects a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.operators.joins import join_null_safe


def leading_rows(df: DataFrame, keys: Sequence[str], order: Sequence, rank: int = 1) -> DataFrame:
    """Rows ranked up to ``rank`` within their key; ties are kept."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.rank().over(window)).where(F.col("_rank") <= rank).drop("_rank")


def latest_rows(df: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    return leading_rows(df, keys, [F.desc(date)])


def earliest_rows(df: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    return leading_rows(df, keys, [F.asc(date)])


def rows_at_extreme(df: DataFrame, keys: Sequence[str], column: str, largest: bool = True) -> DataFrame:
    """Rows whose column equals the largest (or smallest) of their key; ties are kept.

    The extreme is aggregated first; the join back is on (keys, column), so a hot key spreads over
    its values.
    """
    extreme = F.max(column) if largest else F.min(column)
    bounds = df.groupBy(*keys).agg(extreme.alias(column)).where(F.col(column).isNotNull())
    return join_null_safe(df, bounds, [*keys, column], "left_semi")


def one_value_per_key(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """The columns of the key's first row in ``order``; the same answer on every run."""
    return df.groupBy(*keys).agg(*[F.min_by(c, order).alias(c) for c in columns])


def snapshot(old: DataFrame | None, new: DataFrame, keys: Sequence[str] = ("location_id",)) -> DataFrame:
    """Latest row of each key over the old snapshot and the new rows; identical rows collapse."""
    rows = new if old is None else old.unionByName(new.select(*old.columns))
    return latest_rows(rows, keys).distinct()


def lowest_colocated(stations: DataFrame, per_element: bool = True) -> DataFrame:
    """One station per coordinate (and element): the lowest, then the smallest id.

    ``per_element=False`` keeps one station for all elements of a coordinate; elements that only the
    other stations measure are then lost. A station of unknown elevation comes last.
    """
    keys = ["latitude", "longitude"] + (["measured"] if per_element else [])
    return leading_rows(stations, keys, [F.asc_nulls_last("elevation"), F.asc("station_id")])


def one_row_per_station(stations: DataFrame) -> DataFrame:
    """The station's row for its first element."""
    return leading_rows(stations, ["station_id"], [F.asc("measured")])
