"""Connected components of a link table that no single machine can hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.session import staged


def _stars(links: DataFrame, upper_only: bool) -> DataFrame:
    """Point the neighbours of each node (the larger ones only, or the smaller ones and itself) at its least."""
    if upper_only:
        sides = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root")).withColumnRenamed("a", "node")
    joined = sides.join(least, F.col("a") == F.col("node"))
    moved = joined.where(F.col("b") > F.col("a")) if upper_only else joined.where(F.col("b") != F.col("root"))
    moved = moved.select(F.col("b").alias("a"), F.col("root").alias("b"))
    if not upper_only:
        moved = moved.unionByName(least.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every linked node: root is the least node of its component.

    ``links`` has two columns ``a`` and ``b`` of one ordered type. Large and small stars alternate
    until the links no longer change; each round is written to the shared folder, so that neither
    lineage nor recomputation grows with the rounds.
    """
    current = staged(links.where("a <> b").select("a", "b").distinct(), "links")
    seen = None
    while True:
        current = staged(_stars(_stars(current, True), False), "links")
        state = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.expr("sum(pmod(xxhash64(b, a), 1048573))"))
        found = tuple(state.first())
        if found == seen:
            break
        seen = found
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
