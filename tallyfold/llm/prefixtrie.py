"""The trie of conversation prefixes, by Spark SQL's ROLLUP over positional turn-id columns.

A conversation is laid out as rows of ``WIDTH`` turn-id columns, one row per block of its turns. One
ROLLUP over these columns, grouped by the node that the block before ends in, aggregates all prefixes
of all blocks together; ``grouping_id`` tells how deep each result lies. Nodes carry sums of hashes of
(turn, position) as keys: a running sum gives the key of any prefix, so that a conversation of any
length continues from its last block's node without another pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.operators.ordered import running_totals
from tallyfold.session import staged

WIDTH = 8  # turn-id columns of a block
_FAR = 4096  # blocks of a conversation summed up together
_RANGE_BITS = 10  # so many low bits of conversation ids are joined into one string before they are hashed
_KEYS = ["k1", "k2", "k3", "k4"]  # sums of 32 bits of hash each: 2^31 turns in a conversation
_TURNS = [f"t{j}" for j in range(WIDTH)]


def ordered_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(``conv``, ``pos`` from 1, ``turn_id``, ``chars``), positions following ``turn``, null first.

    Rows of the same turn follow their role, then a hash of role and text; repeated rows all count. A null
    role or text is empty. Rows without a conversation id belong to none and are left out. The turn id
    is 128 bits of SHA-256 over role and text with the length of the role. A conversation that holds most
    of the rows is numbered in blocks.
    """
    spoken, said = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat_ws(":", F.length(spoken), spoken, said), 256)
    narrow = rows.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"),
        F.struct(F.col(turn).cast("long").alias("turn"), spoken.alias("role"), F.unhex(F.substring(digest, 1, 32)).alias("id")).alias("at"),
        F.length(said).cast("long").alias("chars"),
    )
    counted = narrow.groupBy("conv", "at", "chars").agg(F.count(F.lit(1)).alias("copies"))
    placed = running_totals(counted, "at", "copies", ["conv"])
    # Copies come back in two steps, so that no array grows with their number.
    stretch = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(_FAR).cast("long")))
    copy = F.explode(F.sequence(F.col("stretch") + 1, F.least(F.col("stretch") + _FAR, "copies")))
    return (
        placed.select("conv", "before", "copies", F.col("at.id").alias("turn_id"), "chars", stretch.alias("stretch"))
        .select("conv", "before", "turn_id", "chars", copy.alias("copy"))
        .select("conv", (F.col("before") + F.col("copy")).alias("pos"), "turn_id", "chars")
    )


def with_shared_heads(turns: DataFrame, most: int = 6, family: int = 100) -> tuple[DataFrame, DataFrame]:
    """Every conversation c rebuilt from the first h turns of conversation c - c % ``family`` and its own
    turns after its first h, where h is crc32 of c's decimal form modulo ``most``.

    Returns the rebuilt turns and all conversation ids, of which some may have no turn left.
    """
    heads = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    base = F.col("conv") - F.col("conv") % family
    convs = turns.select("conv").distinct()
    first = turns.where((F.col("conv") % family == 0) & (F.col("pos") < most)).withColumnRenamed("conv", "base")
    held = first.groupBy("base").agg(F.count(F.lit(1)).alias("held"))
    shared = (
        convs.select("conv", heads.alias("h"), base.alias("base"))
        .join(first, "base")
        .where(F.col("pos") <= F.col("h"))
        .select("conv", "pos", "turn_id", "chars")
    )
    moved = F.col("pos") - F.col("h") + F.least("h", F.coalesce("held", F.lit(0)))
    own = (
        turns.withColumn("h", heads)
        .where(F.col("pos") > F.col("h"))
        .withColumn("base", base)
        .join(held, "base", "left")
        .select("conv", moved.alias("pos"), "turn_id", "chars")
    )
    return shared.unionByName(own), convs


def _hashes(turn_id: Column, pos: Column) -> list[Column]:
    halves = []
    for seed in (1, 2):
        hashed = F.xxhash64(turn_id, pos.cast("long"), F.lit(seed))
        halves += [F.shiftrightunsigned(hashed, 32), hashed.bitwiseAND(F.lit(0xFFFFFFFF))]
    return halves


def _laid_out(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row per block of a conversation, and one row per conversation."""
    slot, block = (F.col("pos") - 1) % WIDTH, F.floor((F.col("pos") - 1) / WIDTH)
    hashed = turns.select("*", *[h.alias(k) for h, k in zip(_hashes(F.col("turn_id"), F.col("pos")), _KEYS)])
    sums = [F.sum(c).alias(c) for c in [*_KEYS, "chars"]]
    whole = hashed.groupBy("conv").agg(F.max("pos").alias("n_turns"), *sums)
    whole = convs.join(whole, "conv", "left").fillna(0, ["n_turns", "chars", *_KEYS])
    turn = F.struct("turn_id", "chars")
    blocks = hashed.groupBy("conv", block.alias("block")).agg(
        *[F.max(F.when(slot == j, turn)).alias(t) for j, t in enumerate(_TURNS)], F.count(F.lit(1)).alias("filled"), *sums
    )
    # What the blocks before sum up to: first over far stretches of a conversation, then inside each.
    far = F.floor(F.col("block") / _FAR)
    blocks = blocks.withColumn("far", far)
    before = Window.partitionBy("conv").orderBy("far").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("conv", "far").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    measures = [*_KEYS, "chars"]
    carried = blocks.groupBy("conv", "far").agg(*sums)
    carried = carried.select("conv", "far", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"far_{c}") for c in measures])
    prior = [(F.col(f"far_{c}") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(f"prior_{c}") for c in measures]
    rows = blocks.join(carried, ["conv", "far"]).select("conv", "block", *_TURNS, "filled", *prior)
    # Turnless conversations are members of the root alone.
    turnless = whole.where("n_turns = 0").select(
        "conv",
        F.lit(0).cast("long").alias("block"),
        *[F.lit(None).cast("struct<turn_id: binary, chars: bigint>").alias(t) for t in _TURNS],
        F.lit(0).cast("long").alias("filled"),
        *[F.lit(0).cast("long").alias(f"prior_{c}") for c in measures],
    )
    return rows.unionByName(turnless), whole


def _rolled_up(rows: DataFrame, measures: str) -> DataFrame:
    """All nodes with ``measures`` over their members: ``depth``, the keys of node and parent, ``chars`` of
    the last text and ``path`` of all texts before it."""
    keys = ", ".join(["block", *[f"prior_{c}" for c in [*_KEYS, "chars"]]])
    turns = ", ".join(_TURNS)
    grouped = rows.sparkSession.sql(
        f"""SELECT {keys}, {turns}, {WIDTH} - bit_count(grouping_id()) AS level,
                   count(*) AS n_convs, min(conv) AS conv_id, {measures}
            FROM {{rows}} GROUP BY {keys}, ROLLUP({turns})""",
        rows=rows,
    )
    listed = F.array(*_TURNS)
    last = F.get(listed, F.col("level") - 1)
    nodes = grouped.withColumn("last", last).where("last IS NOT NULL OR (level = 0 AND block = 0)")
    depth = F.col("block") * WIDTH + F.col("level")
    hashes = [_hashes(F.col(f"{t}.turn_id"), F.col("block") * WIDTH + j + 1) for j, t in enumerate(_TURNS)]

    def up_to(level: Column, prior: str, values: list[Column]) -> Column:
        return sum((F.when(level > j, value).otherwise(0) for j, value in enumerate(values)), F.col(prior))

    sums = [up_to(F.col("level"), f"prior_{k}", [h[i] for h in hashes]) for i, k in enumerate(_KEYS)]
    path = up_to(F.col("level") - 1, "prior_chars", [F.col(f"{t}.chars") for t in _TURNS])
    kept = [c for c in grouped.columns if c not in {*keys.split(", "), *_TURNS}]
    keyed = nodes.select(
        depth.alias("depth"),
        *[s.alias(k) for s, k in zip(sums, _KEYS)],
        path.alias("path"),
        F.coalesce("last.chars", F.lit(0)).alias("chars"),
        F.col("last.turn_id").alias("turn_id"),
        *kept,
    )
    above = [F.when(F.col("depth") > 0, F.col(k) - h).alias(f"up_{k}") for k, h in zip(_KEYS, _hashes(F.col("turn_id"), F.col("depth")))]
    return keyed.select(*[c for c in keyed.columns if c != "turn_id"], *above)


def _ends(whole: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that end at a node, ascending and joined by commas.

    Ids are joined in ranges first; a node's ranges pass one after the other through the hash, so that
    no task holds them together.
    """
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    key = ["depth", *_KEYS]
    joined = (
        whole.select(F.col("n_turns").alias("depth"), *_KEYS, "conv", F.shiftright("conv", _RANGE_BITS).alias("range"))
        .groupBy(*key, "range")
        .agg(ids.alias("ids"))
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            columns = [batch.column(k).to_numpy() for k in key]
            texts = batch.column("ids")
            done: list[tuple[tuple[int, ...], str]] = []
            for i in range(batch.num_rows):
                node = tuple(int(c[i]) for c in columns)
                if node != current:
                    if state is not None:
                        done.append((current, state.hexdigest()))
                    current, state = node, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(texts[i].as_buffer())
            yield _digests(key, done)
        if state is not None:
            yield _digests(key, [(current, state.hexdigest())])

    ordered = joined.repartition(*key).sortWithinPartitions(*key, "range")
    return ordered.mapInArrow(hashed, ", ".join(f"{k} long" for k in key) + ", ends_sha256 string")


def _digests(key: list[str], done: list) -> pa.RecordBatch:
    nodes = np.array([node for node, _ in done], dtype=np.int64).reshape(-1, len(key))
    return pa.RecordBatch.from_arrays([*(pa.array(c) for c in nodes.T), pa.array([d for _, d in done], pa.string())], names=[*key, "ends_sha256"])


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations ``convs`` with the given ``turns`` (as ``ordered_turns`` makes them).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``,
    ``n_leaves`` (childless nodes of the subtree), ``saved_tokens`` (what sharing the prefixes saves over the
    subtree, in code points) and ``ends_sha256`` (of the ids of the conversations that end here). Positions
    run from 1 without gaps. Turnless conversations are members of the root; without conversations there is
    no node.

    Subtree sums need no walk over the tree. Every node is owned by its smallest member; a conversation
    owns the lower end of its path. Over the members of a node, the code points from the node down are
    their whole lengths less the path above, and each text below is counted once by its owner.
    """
    rows, whole = _laid_out(turns, convs)
    rows, whole = staged(rows, "trie_blocks"), staged(whole, "trie_convs")
    ended = whole.select("conv", "n_turns", F.col("chars").alias("own_chars"))
    at_end = F.when(F.col("n_turns") <= (F.col("block") + 1) * WIDTH, F.col("filled")).otherwise(WIDTH + 1)
    nodes = _rolled_up(rows.join(ended, "conv").withColumn("at_end", at_end), "max(at_end) AS last_end")
    owned = (
        nodes.groupBy(F.col("conv_id").alias("conv"))
        .agg(F.sum("chars").alias("owned"), F.sum((F.col("last_end") == F.col("level")).cast("long")).alias("leaf"))
    )
    # A conversation without a node of its own owns no text and stands for no leaf.
    measured = ended.join(owned, "conv", "left").fillna(0, ["owned", "leaf"])
    sums = """sum(leaf) AS n_leaves, sum(own_chars) AS all_chars, sum(owned) AS all_owned,
              min_by(own_chars, conv) AS first_chars, min_by(owned, conv) AS first_owned"""
    nodes = staged(_rolled_up(rows.join(measured, "conv"), sums).drop("level"), "trie_nodes")
    key, above = ["depth", *_KEYS], [f"up_{k}" for k in _KEYS]
    below = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), *[F.col(u).alias(k) for u, k in zip(above, _KEYS)])
    children = below.agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(k).alias(u) for k, u in zip(_KEYS, above)], F.col("conv_id").alias("parent_conv_id"))
    shared = F.col("all_chars") - F.col("n_convs") * F.col("path")
    once = F.col("all_owned") - F.col("first_owned") + F.col("first_chars") - F.col("path")
    return (
        nodes.join(children, key, "left")
        .join(_ends(whole), key, "left")
        .join(parents, ["depth", *above], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            "n_leaves",
            (shared - once).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )
