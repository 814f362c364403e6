"""Distinct days as bitmaps that can be merged: one bit per day of the year, per key and year.

A count of distinct days needs the whole history each time; these do not. Bits of a batch are merged with
the stored ones of the years it touches, a day that comes twice sets the same bit, and a count is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIR = ("station_id", "measured")
WORDS = [f"w{i}" for i in range(6)]  # 64 days each


def day_bits(rows: DataFrame, keys: Sequence[str] = PAIR, date: str = "date") -> DataFrame:
    """(keys, ``year``, ``w0`` to ``w5``): the days on which each key has a row; rows without a date have none."""
    day = F.dayofyear(date) - 1
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), day % 64)
    words = [F.bit_or(F.when(F.floor(day / 64) == i, bit).otherwise(0)).alias(w) for i, w in enumerate(WORDS)]
    return rows.where(F.col(date).isNotNull()).groupBy(*keys, F.year(date).alias("year")).agg(*words)


def merge_bits(bits: DataFrame, more: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """Both sets of days."""
    return bits.unionByName(more).groupBy(*keys, "year").agg(*[F.bit_or(w).alias(w) for w in WORDS])


def count_days(bits: DataFrame, keys: Sequence[str] = PAIR) -> DataFrame:
    """(keys, ``nb_days``): distinct days over all years."""
    days = sum((F.bit_count(w) for w in WORDS), F.lit(0).cast("long"))
    return bits.groupBy(*keys).agg(F.sum(days).alias("nb_days"))
