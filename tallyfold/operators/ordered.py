"""Ordered computations that do not put a whole key, or the whole table, into one task.

A window over one key sorts that key in one task. Here a key is first cut into blocks along the
order column; each block is one window partition, and what a block needs from the blocks before it
arrives as one extra *carry* row at its start. The carry rows come from a partial aggregation, so
the rows themselves are shuffled once, by (key, block).

Blocks are functions of the data (a calendar month, or bounds drawn by hash), never of partition
numbers: a task that is run again gives the same blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BLOCK = "_block"
_CARRY = "_carry"
_FIRST = Window.unboundedPreceding
_FAN = 4096  # bounds placed at a time, a power of two


def block_count(df: DataFrame) -> int:
    """Blocks to cut an order into: four per shuffle partition, as a power of two.

    The shuffle partitions are what a session sizes to its data, so a block stays what one task can
    hold. There is no upper limit: beyond ``_FAN`` blocks the bounds are placed in levels.
    """
    wanted = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(16, 1 << (wanted - 1).bit_length())


def with_value_block(df: DataFrame, column: str, blocks: int | None = None) -> DataFrame:
    """Number the rows' blocks (column ``_block``, from 0) so that blocks hold similar row counts.

    The bounds are quantiles of a sample chosen by hash of the whole row, about 16 values per block of a
    level, so at most 16 * ``_FAN`` values meet in one array. The bounds of the first level are broadcast
    as one row; where more blocks are wanted, each block of a level gets an array of its own, which its
    rows meet in a join. The sample only places bounds; every row stays.
    """
    blocks = blocks or block_count(df)
    hashed = f"xxhash64({', '.join(df.columns)})"
    # Counting the hash keeps the columns the other readers need, so they share one shuffle.
    total = df.agg(F.expr(f"count({hashed}) AS _n"))
    level = min(blocks, _FAN)
    bounds = df.crossJoin(F.broadcast(total)).where(_sampled(hashed, 16 * level)).agg(_collected(column)).selectExpr(_placed(level))
    out = _counted(df.crossJoin(F.broadcast(bounds)).selectExpr("*", f"0L AS {_BLOCK}"), df.columns, column, level)
    placed = level
    while placed < blocks:
        level = min(blocks // placed, _FAN)
        # Each of the placed blocks holds its share of so many values.
        rows = out.crossJoin(F.broadcast(total)).where(_sampled(hashed, 16 * placed * level))
        bounds = rows.groupBy(_BLOCK).agg(_collected(column)).selectExpr(f"{_BLOCK} AS _above", _placed(level))
        met = out.withColumnRenamed(_BLOCK, "_above").join(bounds, "_above", "left")
        inner = _counted(met.selectExpr("*", f"0L AS {_BLOCK}"), [*df.columns, "_above"], column, level)
        out = inner.selectExpr(*df.columns, f"_above * {level} + {_BLOCK} AS {_BLOCK}")
        placed *= level
    return out


def _sampled(hashed: str, wanted: int) -> str:
    """About ``wanted`` of the ``_n`` rows, the same on every run."""
    return f"(double({hashed}) + {2.0**63!r}D) / {2.0**64!r}D * _n < {wanted}"


def _collected(column: str) -> Column:
    return F.expr(f"array_sort(collect_list({column})) AS _sample")


def _placed(blocks: int) -> str:
    """Bounds between ``blocks`` parts of the sample."""
    at = f"int(floor(bigint(i) * size(_sample) / {blocks}))"
    return f"transform(sequence(1, {blocks - 1}), i -> get(_sample, {at})) AS _bounds"


def _counted(rows: DataFrame, others: Sequence[str], column: str, blocks: int) -> DataFrame:
    """The number of bounds below the value, by binary search, one power of two at a time."""
    step = blocks // 2
    while step:
        below = f"get(_bounds, int({_BLOCK} + {step - 1})) < {column}"
        rows = rows.selectExpr(*others, "_bounds", f"{_BLOCK} + IF({below}, {step}L, 0L) AS {_BLOCK}")
        step //= 2
    return rows.drop("_bounds")


def running_totals(
    df: DataFrame,
    order: str,
    measure: str,
    keys: Sequence[str] = (),
    descending: bool = False,
    block: Column | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """Add ``before`` (sum of ``measure`` over the rows of the key that sort earlier) and ``total``.

    Needs one row per (keys, order) with a non-null order. ``block`` must not decrease along the
    order; without it, blocks are bounds of the order's own values.
    """
    blocked = df.withColumn(_BLOCK, block) if block is not None else with_value_block(df, order, blocks)
    direction = F.desc if descending else F.asc
    # One row per (key, block): the window over a key sees at most its blocks.
    sums = blocked.groupBy(*keys, _BLOCK).agg(F.sum(measure).alias("_sum"))
    across = Window.partitionBy(*(keys or [F.lit(0)]))
    earlier = across.orderBy(direction(_BLOCK)).rowsBetween(_FIRST, -1)
    carry = sums.select(
        *keys,
        _BLOCK,
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias(measure),
        F.sum("_sum").over(across).alias("_total"),
        F.lit(True).alias(_CARRY),
    )
    rows = blocked.withColumn(_CARRY, F.lit(False))
    within = Window.partitionBy(*keys, _BLOCK).orderBy(F.desc(_CARRY), direction(order))
    return (
        rows.unionByName(carry, allowMissingColumns=True)
        .withColumn("before", F.sum(measure).over(within.rowsBetween(_FIRST, -1)))
        .withColumn("total", F.first("_total", ignorenulls=True).over(within.rowsBetween(_FIRST, 0)))
        .where(~F.col(_CARRY))
        .drop(_BLOCK, _CARRY, "_total")
    )


def previous_values(
    df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], block: Column | None = None
) -> DataFrame:
    """Add ``<column>_previous``: the value on the key's preceding row, null on its first.

    With ``block`` (non-decreasing along the order, such as the month of a date) a long series is
    spread over one window partition per block.
    """
    if block is None:
        window = Window.partitionBy(*keys).orderBy(order)
        return df.select("*", *[F.lag(c).over(window).alias(f"{c}_previous") for c in columns])
    blocked = df.withColumn(_BLOCK, block)
    last = blocked.groupBy(*keys, _BLOCK).agg(*[F.max_by(c, order).alias(c) for c in columns])
    following = F.lead(_BLOCK).over(Window.partitionBy(*keys).orderBy(_BLOCK))
    carry = (
        last.withColumn(_BLOCK, following).where(F.col(_BLOCK).isNotNull()).withColumn(_CARRY, F.lit(True))
    )
    within = Window.partitionBy(*keys, _BLOCK).orderBy(F.desc(_CARRY), order)
    return (
        blocked.withColumn(_CARRY, F.lit(False))
        .unionByName(carry, allowMissingColumns=True)
        .select("*", *[F.lag(c).over(within).alias(f"{c}_previous") for c in columns])
        .where(~F.col(_CARRY))
        .drop(_BLOCK, _CARRY)
    )


def row_positions(
    df: DataFrame, keys: Sequence[str], order: str, block: Column | None = None, name: str = "pos"
) -> DataFrame:
    """Add the row's number within its key, from 0. Needs one row per (keys, order)."""
    counted = df.withColumn("_one", F.lit(1).cast("long"))
    return running_totals(counted, order, "_one", keys, block=block).withColumnRenamed("before", name).drop(
        "_one", "total"
    )


def value_counts_before(
    df: DataFrame, value: str, keys: Sequence[str] = (), descending: bool = False, blocks: int | None = None
) -> DataFrame:
    """One row per (keys, value) with ``n``, ``before`` and ``total``; nulls and NaN are left out."""
    counts = (
        df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return running_totals(counts, value, "n", keys, descending, blocks=blocks)


def rank_table(rows: DataFrame, value: str, name: str, descending: bool = True, blocks: int | None = None) -> DataFrame:
    """The competition rank of each distinct value (ties share the lowest), as (``_ranked``, name).

    Equal values are counted before they are ordered, and no window sees more than one block.
    """
    counted = value_counts_before(rows, value, (), descending, blocks)
    return counted.select(F.col(value).alias("_ranked"), (F.col("before") + 1).alias(name))


def global_rank(df: DataFrame, value: str, name: str, descending: bool = True, blocks: int | None = None) -> DataFrame:
    """Add the rank of ``value`` over the whole table; a null value has a null rank."""
    ranks = rank_table(df, value, name, descending, blocks)
    return df.join(ranks, F.col(value) == F.col("_ranked"), "left").drop("_ranked")


def quantiles(df: DataFrame, value: str, probabilities: dict[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per key, one column per probability.

    Value counts are ordered block by block; only the two values around each position go on.
    """
    counted = value_counts_before(df, value, keys)
    upto = F.col("before") + F.col("n")
    aggregates, results = [], []
    for name, p in probabilities.items():
        position = (F.col("total") - 1) * F.lit(float(p))
        for side, rounded in (("low", F.floor(position)), ("high", F.ceil(position))):
            hit = (F.col("before") <= rounded) & (rounded < upto)
            aggregates.append(F.max(F.when(hit, F.col(value).cast("double"))).alias(f"_{side}_{name}"))
        aggregates.append(F.max(position - F.floor(position)).alias(f"_part_{name}"))
        low, high, part = F.col(f"_low_{name}"), F.col(f"_high_{name}"), F.col(f"_part_{name}")
        results.append((low + (high - low) * part).alias(name))
    return counted.groupBy(*keys).agg(*aggregates).select(*keys, *results)
