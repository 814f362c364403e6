"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents fall into blocks of about ``block_words`` words by hash. A source's quota is
the exact run of blocks, over two passes at most, whose words add up to its target; the last block is
cut. The tree deals the quotas to output shards: at each node the blocks that go left are drawn
without replacement from all sources at once. Every shard walks its own path from the root with the
nodes' own seeds, so the tree is never held in one place and a lost task draws the same again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.common import broadcast_within, packed, text_hash
from tallyfold.operators.ordered import row_positions, running_totals
from tallyfold.session import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
BROADCAST_SOURCES = 100_000
#: What numpy's hypergeometric draw accepts in one node.
MOST_BLOCKS = 999_999_999


def word_count(text: str | Column) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = WEIGHTS
) -> DataFrame:
    """(``source``, ``source_size``) to those with ``number`` (by code point, null last) and ``target``.

    The targets share ``share`` times all sizes by the repeating weights. None passes ``most`` times
    its source's size; the excess is shared again. In the order of size to weight, a source is full
    if its part of what the fuller ones leave exceeds its limit. One row per source goes to one task.
    """
    number = Window.orderBy(F.asc_nulls_last("source"))
    rows = sizes.withColumn("number", F.row_number().over(number) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("number") % len(weights) + 1)
    rows = rows.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(most)))
    filling = Window.orderBy(F.col("most") / F.col("weight"), "number")
    left = F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy(F.lit(0))) - F.coalesce(
        F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    per_weight = left / F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("level", per_weight)
    full = F.col("most") <= F.col("level") * F.col("weight")
    level = F.max(F.when(~full, F.col("level"))).over(Window.partitionBy(F.lit(0)))
    target = F.when(full, F.col("most")).otherwise(level * F.col("weight"))
    return rows.withColumn("target", target).select("source", "source_size", "number", "target")


def shard_slices(quotas: list[int], shards: int, seed: int, shard: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, count) per source of the blocks that the tree deals to ``shard``."""
    total = sum(quotas)
    bound = [total * i // shards for i in range(shards + 1)]
    low, high = 0, shards
    counts, first = np.array(quotas, dtype=np.int64), np.zeros(len(quotas), dtype=np.int64)
    while high - low > 1:
        middle = (low + high) // 2
        draw = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(
            counts, bound[middle] - bound[low], method="marginals"
        )
        if shard < middle:
            counts, high = draw, middle
        else:
            counts, first, low = counts - draw, first + draw, middle
    return first, counts


def _dealt(units: DataFrame, shard_blocks: int, seed: int) -> DataFrame:
    """``units`` (number, rank) with the ``shard`` that the tree deals them to."""
    found = {r.number: r.quota for r in units.groupBy("number").agg(F.count(F.lit(1)).alias("quota")).collect()}
    numbers = sorted(found)  # one entry per source
    quotas = [found[n] for n in numbers]
    if sum(quotas) > MOST_BLOCKS:
        raise ValueError("too many blocks for one draw: raise block_words")
    shards = max(1, -(-sum(quotas) // shard_blocks))

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"]:
                first, counts = shard_slices(quotas, shards, seed, int(shard))
                yield pd.DataFrame({"shard": shard, "number": numbers, "first": first, "n": counts})

    slices = units.sparkSession.range(shards).mapInPandas(walk, "shard long, number int, first long, n long").where("n > 0")
    places = slices.select("shard", "number", F.explode(F.expr("sequence(first, first + n - 1)")).alias("rank"))
    return units.join(places, ["number", "rank"])


def mix_plan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    share: float = 1.5,
    most: int = 2,
    weights: tuple[int, ...] = WEIGHTS,
    block_words: int = 32_768,
    shard_blocks: int = 32,
    seed: int = 42,
) -> DataFrame:
    """Each row of ``docs`` as ``row`` with ``doc_id``, ``text_key``, ``size``, ``source_size``, ``target``
    and ``copies``: an array of (``pass``, ``shard``, ``taken`` words).

    Every source gives the words of its target, rounded; the last document of a pass may be cut. A
    null or wordless text has size 0 and no copy; null is a source of its own, the last; a null id is
    an id. Repeated rows are separate rows of one block. An empty table gives an empty plan. Other
    columns stay inside ``row``, so that their names cannot clash.
    """
    keyed = packed(docs, doc_id=F.col(doc_id), text_key=text_hash(text), source=F.col(source), size=word_count(text))
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = staged(source_targets(sizes, share, most, weights), "sources").alias("s")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(block_words)))
    rows = (
        keyed.alias("d")
        .join(broadcast_within(sources, BROADCAST_SOURCES), F.col("d.source").eqNullSafe(F.col("s.source")))
        .select("row", "doc_id", "text_key", "size", "source_size", "target", "number")
        .withColumn("block", F.pmod(F.xxhash64("doc_id", "text_key", F.lit(seed)), blocks))
    )
    sums = rows.where("size > 0").groupBy("number", "block", "source_size", "target").agg(F.sum("size").alias("words"))
    # A hot source has many blocks: their running sum is taken in stretches of 4096.
    counted = staged(sums, "blocks").withColumn("measure", F.col("words"))
    ordered = running_totals(counted, "block", "measure", ["number"], block=F.floor(F.col("block") / 4096))
    each = ordered.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    rest = F.round("target").cast("long") - F.col("pass") * F.col("source_size") - F.col("before")
    units = each.withColumn("taken", F.least("words", rest)).where("taken > 0").select("number", "block", "pass", "taken")
    units = staged(units.withColumn("order", F.xxhash64("number", "pass", "block", F.lit(seed))), "units")
    ranked = staged(row_positions(units, ["number"], "order", block=F.shiftright("order", 52), name="rank"), "ranked")
    dealt = _dealt(ranked, shard_blocks, seed)
    plan = dealt.groupBy("number", "block").agg(
        F.sort_array(F.collect_list(F.struct("pass", "shard", "taken"))).alias("units")
    )
    within = Window.partitionBy("number", "block").orderBy(F.xxhash64("text_key", "doc_id", F.lit(seed)), "doc_id", "text_key")
    start = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    placed = rows.join(staged(plan, "plan"), ["number", "block"], "left").withColumn("start", start)
    copies = F.transform(
        F.coalesce("units", F.array().cast("array<struct<pass:int,shard:bigint,taken:bigint>>")),
        lambda u: F.struct(
            u["pass"].alias("pass"),
            u["shard"].alias("shard"),
            F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), u["taken"] - F.col("start"))).alias("taken"),
        ),
    )
    copies = F.filter(copies, lambda c: c["taken"] > 0)
    return placed.select("row", "doc_id", "text_key", "size", "source_size", "target", copies.alias("copies"))


def mixed(docs: DataFrame, text: str = "text", seed: int = 42, **options) -> DataFrame:
    """The mix: the columns of ``docs`` once per copy, shuffled inside each output ``mix_shard``.

    A cut copy keeps its first ``taken`` words and the white space before them. ``mix_shard`` and
    ``mix_pass`` follow the columns of ``docs`` and replace columns of these names.
    """
    plan = mix_plan(docs, text=text, seed=seed, **options)
    each = plan.select("row", "doc_id", "text_key", "size", F.explode("copies").alias("copy"))
    whole = F.col("row").getField(text)
    pieces = F.regexp_extract_all(whole, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("copy.taken").cast("int")), "")
    kept = F.when(F.col("copy.taken") < F.col("size"), cut).otherwise(whole)
    names = [c for c in docs.columns if c not in ("mix_shard", "mix_pass")]
    columns = [kept.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in names]
    order = F.xxhash64("doc_id", "text_key", "copy.pass", F.lit(seed))
    return (
        each.repartition("copy.shard")
        .sortWithinPartitions("copy.shard", order)
        .select(*columns, F.col("copy.shard").alias("mix_shard"), F.col("copy.pass").alias("mix_pass"))
    )
