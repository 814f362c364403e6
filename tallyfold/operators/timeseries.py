"""Cumulative series to daily ones, and the series derived from them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.ordered import previous_values

FIRST_ROW_RULES = ("zero", "null", "self")


def month_of(date: str) -> Column:
    return F.trunc(F.col(date), "month")


def daily_increments(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    date: str = "date",
    first: str = "zero",
    block: Column | str | None = "month",
) -> DataFrame:
    """Add ``daily_<measure>`` for every cumulated measure.

    First row of a key: ``zero`` counts from 0, ``null`` leaves it open, ``self`` takes the row's own
    value and does so too after a missing value. A day that a key has twice with the same counts is
    taken once; with different counts it fails the job. A key is spread over one window per month;
    ``block`` may be another column that does not decrease along the date, or None for one window.
    """
    if first not in FIRST_ROW_RULES:
        raise ValueError(f"first must be one of {FIRST_ROW_RULES}")
    if isinstance(block, str):
        block = month_of(date)
    marker = "_seen"
    rows = previous_values(df.withColumn(marker, F.lit(True)), keys, date, [*measures, marker, date], block)
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in [*keys, date]])
    twice = F.coalesce(F.col(f"{date}_previous") == F.col(date), F.lit(False))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"{c}_previous")) for c in measures])
    conflict = F.raise_error(F.concat(F.lit("different counts on one day of "), shown)).cast("boolean")
    rows = rows.where(F.when(~twice, F.lit(True)).when(same, F.lit(False)).otherwise(conflict))
    for name in measures:
        value, previous = F.col(name), F.col(f"{name}_previous")
        if first == "zero":
            previous = F.when(F.col(f"{marker}_previous").isNull(), F.lit(0)).otherwise(previous)
        step = value - previous
        rows = rows.withColumn(f"daily_{name}", F.coalesce(step, value) if first == "self" else step)
    return rows.drop(marker, *[f"{c}_previous" for c in [*measures, marker, date]])


def territory_series(df: DataFrame, keys: Sequence[str], measures: Sequence[str], date: str = "date") -> DataFrame:
    """Sum the cumulated measures per (territory, day), then take the increments from 0."""
    sums = df.groupBy(*keys, date).agg(*[F.sum(c).alias(c) for c in measures])
    return daily_increments(sums, keys, measures, date, first="zero")


def negative_increments(daily: DataFrame, measure: str, below: float = 0) -> DataFrame:
    """Days on which a cumulated total was revised downwards."""
    return daily.where(F.col(measure) < below)


def weekday_profile(daily: DataFrame, measures: Sequence[str], date: str = "date") -> DataFrame:
    """Sums per day of the week, Monday = 0."""
    return daily.groupBy(F.weekday(date).alias("dayofweek")).agg(*[F.sum(c).alias(c) for c in measures])


def calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """Every day from the first to the last date of the table."""
    ends = df.agg(F.min(date).alias("_from"), F.max(date).alias("_to")).where(F.col("_from").isNotNull())
    return ends.select(F.explode(F.sequence("_from", "_to")).alias(date))


def date_slice(df: DataFrame, start: str, end: str, date: str = "date") -> DataFrame:
    """Rows from ``start`` to ``end``, both days included."""
    return df.where(F.col(date).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def newer_than(df: DataFrame, last: DataFrame, date: str = "date") -> DataFrame:
    """Rows after the date in ``last`` (one row, one column); all rows while that is null.

    The one value is read first, so that the comparison prunes directories and row groups.
    """
    value = last.first()[0]
    return df if value is None else df.where(F.col(date) > F.lit(value))


def last_loaded(fact: DataFrame, date: str = "date") -> DataFrame:
    return fact.agg(F.max(date).alias("last"))
