"""Insert, update and delete deltas on the weather fact."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.joins import join_null_safe, keep_known

KEYS = ("measured", "station_id", "date")
ORDERS = (("delete", "insert", "update"), ("delete", "update", "insert"))


def relevant(rows: DataFrame, selected: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that passed the quality check and belong to a selected (station, element) pair."""
    passed = rows.where(F.col("quality_flag").isNull()).select(*columns)
    return keep_known(passed, selected, ["station_id", "measured"])


def delete_rows(fact: DataFrame, deletes: DataFrame) -> DataFrame:
    """Fact without the rows equal to a delete row in all columns; nulls are equal."""
    return join_null_safe(fact, deletes.select(*fact.columns), fact.columns, "left_anti")


def one_per_key(
    delta: DataFrame, keys: Sequence[str] = KEYS, order: str | None = None, what: str = "delta"
) -> DataFrame:
    """Delta with one row per key. Identical rows collapse.

    Rows of one key that differ fail the job, unless ``order`` names a column whose highest value wins.
    """
    others = [c for c in delta.columns if c not in keys and c != order]
    if order:
        return delta.groupBy(*keys).agg(*[F.max_by(c, order).alias(c) for c in others])
    grouped = delta.groupBy(*keys).agg(
        *[F.min(c).alias(c) for c in others],
        *[F.max(c).alias(f"_max_{c}") for c in others],
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(c).alias(f"_count_{c}") for c in others],
    )
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    same = F.lit(True)
    for c in others:
        all_null = F.col(f"_count_{c}") == 0
        none_null = F.col(f"_count_{c}") == F.col("_rows")
        same = same & (all_null | (none_null & (F.col(c) == F.col(f"_max_{c}"))))
    checked = F.when(same, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit(f"{what} has different rows for key "), shown)).cast("boolean")
    )
    return grouped.where(checked).select(*keys, *others)


def upsert(
    fact: DataFrame, new: DataFrame, keys: Sequence[str] = KEYS, order: str | None = None
) -> DataFrame:
    """New rows replace the fact's row of the same key or are added."""
    rows = one_per_key(new, keys, order).select(*fact.columns)
    return join_null_safe(fact, rows, keys, "left_anti").unionByName(rows)


def apply_delta(
    fact: DataFrame,
    delete: DataFrame,
    insert: DataFrame,
    update: DataFrame,
    order: Sequence[str] = ORDERS[0],
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Delete, then write insert and update in the given order; the later one wins a shared key.

    Insert and update are merged first, as the small sides. Deletes and writes then meet the fact in
    one anti-join by key, so a large fact is shuffled once, or not at all when the deltas are small
    enough to broadcast.
    """
    if tuple(order) not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    parts = {"insert": insert.select(*fact.columns), "update": update.select(*fact.columns)}
    early, late = parts[order[1]], parts[order[2]]
    writes = upsert(one_per_key(early, keys).select(*fact.columns), late, keys)
    marks = (
        delete.select(*fact.columns, F.lit(False).alias("_write"))
        .unionByName(writes.select(*keys, F.lit(True).alias("_write")), allowMissingColumns=True)
        .withColumnsRenamed({c: f"_mark_{c}" for c in fact.columns})
    )
    same = {c: F.col(c).eqNullSafe(F.col(f"_mark_{c}")) for c in fact.columns}
    same_key = reduce(Column.__and__, [same[k] for k in keys])
    same_rest = reduce(Column.__and__, [same[c] for c in fact.columns if c not in keys], F.lit(True))
    kept = fact.join(marks, same_key & (F.col("_write") | same_rest), "left_anti")
    return kept.unionByName(writes)
