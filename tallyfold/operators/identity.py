"""Ids of natural keys, kept in a dictionary.

A hash of the key is the id of nearly every key. A key whose hash another key holds already takes the
next hash instead of stopping the load, and keeps it from then on, since known keys are never
numbered again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.columns import seeded_id
from tallyfold.operators.joins import join_null_safe
from tallyfold.session import staged

_MOST_HASHES = 16


def new_ids(
    keys: DataFrame,
    known: DataFrame,
    columns: Sequence[str],
    id_column: str,
    hashed: Callable[..., Column] = seeded_id,
    stage: Callable[[DataFrame, str], DataFrame] = staged,
) -> DataFrame:
    """(columns, id) of the keys that ``known`` (columns, id) does not list; two nulls are the same key.

    Of new keys with one hash the smallest takes it, if no known key does. The others go on to the next
    hash, so each round handles what collided in the one before: nearly always nothing.
    """
    columns = list(columns)
    taken = known.select(id_column)
    left = stage(join_null_safe(keys.select(*columns).distinct(), known.select(*columns), columns, "left_anti"), "new-keys")
    found: list[DataFrame] = []
    for seed in range(_MOST_HASHES):
        first = left.groupBy(hashed(seed, *columns).alias(id_column)).agg(F.min(F.struct(*columns)).alias("_key"))
        won = stage(first.join(taken, id_column, "left_anti").select(*[F.col(f"_key.{c}").alias(c) for c in columns], id_column), "new-ids")
        found.append(won)
        left = stage(join_null_safe(left, won, columns, "left_anti"), "new-keys")
        if left.isEmpty():
            return reduce(DataFrame.unionByName, found)
        taken = taken.unionByName(won.select(id_column))
    raise ValueError(f"keys collide under {_MOST_HASHES} hashes")
