"""Database tables over JDBC. The driver jar and the credentials are the caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, **extra: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, **extra}


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    split_column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    **extra: str,
) -> DataFrame:
    """Read a table; with a split column, in parallel ranges (rows outside the bounds come too)."""
    options = jdbc_options(url, table, **extra)
    if split_column:
        if bounds is None:
            raise ValueError("a split column needs bounds")
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(**options).load()
