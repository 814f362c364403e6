"""Long to wide and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.joins import join_null_safe


def replicate_per_element(rows: DataFrame, elements: Sequence[str], name: str = "element") -> DataFrame:
    """Every row once per element of a short list."""
    return rows.withColumn(name, F.explode(F.array(*[F.lit(e) for e in elements])))


def pivot_elements(
    rows: DataFrame, keys: Sequence[str], element: str, value: str, elements: Sequence[str], order: str
) -> DataFrame:
    """One column per listed element with the first value in ``order``; no pass to find the elements."""
    return rows.groupBy(*keys).pivot(element, list(elements)).agg(F.min_by(value, order))


def crosstab_sums(
    rows: DataFrame, row_key: str, flag: Column, measure: str, categories: dict[object, str]
) -> DataFrame:
    """Sum of a measure per row key and category; null where the combination does not occur."""
    columns = [F.sum(F.when(flag == value, F.col(measure))).alias(name) for value, name in categories.items()]
    return rows.groupBy(row_key).agg(*columns)


def attach_observations(
    cases: DataFrame, observations: DataFrame, place: Sequence[str], date: str = "date"
) -> DataFrame:
    """Case rows beside the observations of their place and day; days without any keep a null."""
    return join_null_safe(cases, observations, [*place, date], "left")


def filtered_observations(observations: DataFrame, mapping: DataFrame) -> DataFrame:
    """Observations of mapped stations, with the location they stand for."""
    selected = mapping.select(F.col("element").alias("measured"), *[c for c in mapping.columns if c != "element"])
    return observations.join(selected, ["station_id", "measured"]).withColumnRenamed("measured", "element")


def stack_sources(sources: dict[str, DataFrame], name: str = "element") -> DataFrame:
    """Union by name with a column that tells the source."""
    parts = [df.withColumn(name, F.lit(key)) for key, df in sources.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the number of rows and two sums of 64-bit row hashes, whatever the order of the rows.

    Repeated rows add up. Sums are kept whole, so frames with equal fingerprints hold the same rows but for
    a chance of one in 2^128; rows that compare as equal in another type or sign may hash apart.
    """
    marked = [c for name in columns or df.columns for c in (F.col(name), F.col(name).isNull())]
    sums = [F.sum(F.xxhash64(F.lit(seed), *marked).cast("decimal(38,0)")).alias(f"hash_{seed}") for seed in (1, 2)]
    return df.agg(F.count(F.lit(1)).alias("rows"), *sums)


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: whether both frames hold the same rows equally often.

    Each side is scanned once and nothing is shuffled but two fingerprints; only where these differ are
    the rows themselves compared.
    """
    columns = left.columns
    prints = [fingerprint(side, columns).first() for side in (left, right)]
    if prints[0] == prints[1]:
        return left.sparkSession.range(1).select(F.lit(True).alias("equal"))
    if prints[0].rows != prints[1].rows:
        return left.sparkSession.range(1).select(F.lit(False).alias("equal"))
    sides = left.select(*columns, F.lit(1).alias("_side")).unionByName(
        right.select(*columns, F.lit(-1).alias("_side"))
    )
    different = sides.groupBy(*columns).agg(F.sum("_side").alias("_balance")).where(F.col("_balance") != 0)
    return different.agg((F.count(F.lit(1)) == 0).alias("equal"))


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()
