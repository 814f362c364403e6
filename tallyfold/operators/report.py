"""Reports: shares, ranks, frequencies, summaries, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.columns import null_if, number_or_null, ratio
from tallyfold.operators.joins import attach_total, join_null_safe
from tallyfold.operators.ordered import quantiles, rank_table


def totals_per_location(cumulated: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Total of a cumulated measure: its largest value per key."""
    return cumulated.groupBy(*keys).agg(*[F.max(c).alias(c) for c in measures])


def with_shares(rows: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Add ``ratio_<measure>``: the row's share of the sum over all rows."""
    sums = rows.agg(*[F.sum(c).alias(f"_sum_{c}") for c in measures])
    out = attach_total(rows, sums)
    shares = [ratio(c, f"_sum_{c}").alias(f"ratio_{c}") for c in measures]
    return out.select(*rows.columns, *shares)


def with_ranks(rows: DataFrame, measures: Sequence[str], base: DataFrame | None = None) -> DataFrame:
    """Add ``rank_<measure>``: competition rank, the largest first.

    Every rank is taken from ``base`` (by default the rows themselves), never from a frame that
    already carries a rank.
    """
    base = rows if base is None else base
    for name in measures:
        ranks = rank_table(base.select(name), name, f"rank_{name}")
        rows = rows.join(ranks, F.col(name) == F.col("_ranked"), "left").drop("_ranked")
    return rows


def rank_and_share(rows: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Rank and share of the total for each measure. The rows are read several times: stage dear ones."""
    return with_ranks(with_shares(rows, measures), measures, base=rows)


def share_of(rows: DataFrame, condition: Column, name: str = "share") -> DataFrame:
    """One row: the part of all rows for which the condition holds."""
    return rows.agg(ratio(F.count_if(condition), F.count(F.lit(1))).alias(name))


def top_rows(rows: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return rows.orderBy(*order).limit(k)


def value_counts(rows: DataFrame, columns: Sequence[str], keep_null: bool = True) -> DataFrame:
    """Frequency of each combination, most frequent first."""
    kept = rows if keep_null else rows.dropna(subset=list(columns))
    return kept.groupBy(*columns).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), *columns)


def duplicates(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def count_range(rows: DataFrame, keys: Sequence[str], group: Sequence[str], value: str) -> DataFrame:
    """Smallest and largest number of non-null values per key, over the keys of each group."""
    per_key = rows.groupBy(*keys).agg(F.count(value).alias("_n"))
    return per_key.groupBy(*group).agg(F.min("_n").alias("min_count"), F.max("_n").alias("max_count"))


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _without_nan(rows: DataFrame, *values: str) -> DataFrame:
    """NaN becomes null, which every statistic skips."""
    return rows.withColumns({value: number_or_null(value) for value in values})


def describe(rows: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of a numeric column."""
    present = _without_nan(rows, value).where(F.col(value).isNotNull())
    simple = present.groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    return _beside(simple, quantiles(present, value, QUARTILES, keys), keys)


def group_summary(rows: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Mean, exact median, extremes and size of each group, the largest group first."""
    rows = _without_nan(rows, value)
    simple = rows.groupBy(*keys).agg(
        F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), F.count(F.lit(1)).alias("len")
    )
    return _beside(simple, quantiles(rows, value, {"median": 0.5}, keys), keys).orderBy(F.desc("len"), *keys)


def _beside(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    if keys:
        return join_null_safe(left, right, keys, "left")
    return left.crossJoin(F.broadcast(right))


def histogram(rows: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Rows per bin of equal width between the extremes; the last bin includes its upper edge.

    Null and NaN are in no bin.
    """
    rows = _without_nan(rows, value)
    ends = rows.agg(F.min(value).cast("double").alias("_low"), F.max(value).cast("double").alias("_high"))
    width = (F.col("_high") - F.col("_low")) / bins
    number = F.least(
        F.coalesce(F.floor((F.col(value) - F.col("_low")) / null_if(width, 0.0)), F.lit(0)), F.lit(bins - 1)
    )
    counted = (
        rows.where(F.col(value).isNotNull())
        .crossJoin(F.broadcast(ends))
        .groupBy(number.cast("int").alias("bin"), "_low", "_high")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return counted.select("bin", (F.col("_low") + width * F.col("bin")).alias("lower_edge"), "count")


def centroid(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean coordinates of each group, without null and NaN."""
    rows = _without_nan(rows, "latitude", "longitude")
    return rows.groupBy(*keys).agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))


def coordinate_range(rows: DataFrame) -> DataFrame:
    """Extremes of the coordinates, without null and NaN."""
    rows = _without_nan(rows, "latitude", "longitude")
    sides = [(F.min, "min"), (F.max, "max")]
    return rows.agg(*[f(c).alias(f"{n}_{c}") for c in ("latitude", "longitude") for f, n in sides])
