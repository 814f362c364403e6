"""Joins with the null and uniqueness rules of the case and weather tables.

No hint is given except for sides of at most a few rows: Catalyst checks the size of a side before it
broadcasts it, and AQE splits the partitions of a hot key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = Iterable[str | tuple[str, str]]


def _pairs(on: Keys) -> list[tuple[str, str]]:
    return [(key, key) if isinstance(key, str) else key for key in on]


def join_on(left: DataFrame, right: DataFrame, on: Keys, how: str = "inner") -> DataFrame:
    """Equi-join on columns that may differ in name; the left names stay."""
    return _join(left, right, _pairs(on), how, lambda a, b: a == b)


def join_null_safe(left: DataFrame, right: DataFrame, on: Keys, how: str = "inner") -> DataFrame:
    """Equi-join under which two nulls match."""
    return _join(left, right, _pairs(on), how, lambda a, b: a.eqNullSafe(b))


def _join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], how: str, test) -> DataFrame:
    right_names = {b: f"_right_{b}" for _, b in pairs}
    renamed = right.withColumnsRenamed(right_names)
    condition = reduce(Column.__and__, [test(F.col(a), F.col(right_names[b])) for a, b in pairs])
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*right_names.values())


def keep_known(rows: DataFrame, known: DataFrame, on: Keys) -> DataFrame:
    """Rows whose key occurs in ``known``; a key listed twice does not multiply rows."""
    return join_on(rows, known, on, "left_semi")


def without_known(rows: DataFrame, known: DataFrame, on: Keys) -> DataFrame:
    """Rows whose key does not occur in ``known``; rows with a null key always stay."""
    return join_on(rows, known, on, "left_anti")


def without_known_null_safe(rows: DataFrame, known: DataFrame, on: Keys) -> DataFrame:
    return join_null_safe(rows, known, on, "left_anti")


def without_either(rows: DataFrame, known: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows none of whose columns occurs in the same column of ``known``."""
    for name in columns:
        rows = rows.join(known.select(name).where(F.col(name).isNotNull()).distinct(), name, "left_anti")
    return rows


def attach_total(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """Put the columns of a one-row aggregate beside every row."""
    return rows.crossJoin(F.broadcast(totals))


def one_row_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows; the job fails when a key occurs twice.

    The check rides on one partial aggregation by key, so a hot key is reduced before the shuffle and
    a join on the same keys reuses the partitioning.
    """
    others = [c for c in df.columns if c not in keys]
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.any_value(c).alias(c) for c in others]
    )
    checked = F.when(
        F.col("_rows") > 1, F.raise_error(F.concat(F.lit(f"key ({', '.join(keys)}) repeats: "), shown)).cast("boolean")
    ).otherwise(F.lit(True))
    return grouped.where(checked).select(*df.columns)


def join_one_to_one(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join that fails when a key repeats on either side."""
    return one_row_per_key(left, on).join(one_row_per_key(right, on), list(on), how)


def split_matched(rows: DataFrame, id_column: str) -> tuple[DataFrame, DataFrame]:
    """Rows that found a partner, and the report of those that did not."""
    return rows.where(F.col(id_column).isNotNull()), rows.where(F.col(id_column).isNull()).drop(id_column)
