"""Writers. Rows are brought together by partition value first, so a partition holds few files; AQE
splits the partitions that hold too much for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str, replaced: str) -> None:
    writer = df.hint("rebalance", *by).write.mode(mode).option("partitionOverwriteMode", replaced)
    writer.partitionBy(*by).parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Parquet by partition columns, in place of the whole data set that was there."""
    _write_partitioned(df, path, by, "overwrite", "static")


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Parquet by partition columns, in place of the partitions that are written; others stay."""
    _write_partitioned(df, path, by, "overwrite", "dynamic")


def write_new_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """As above, but fails when the data set exists."""
    _write_partitioned(df, path, by, "errorifexists", "static")


def write_flat(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """CSV with a header, one directory per value of the given columns."""
    if by:
        df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).option("header", True).csv(path)
    else:
        df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Add rows; those of one partition value are brought together first. Running it again adds them
    again: a job that may be repeated appends to a ``CommittedTable``."""
    df.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(path)


def write_version(df: DataFrame, path: str, version: int) -> None:
    """Write a whole new version of a table beside the old ones, which stay readable."""
    df.write.mode("overwrite").parquet(f"{path}/version={version:010d}")


def current_version(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """Highest version whose write finished (below ``before``, if given)."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(pattern) or []
    versions = [int(s.getPath().getParent().getName().removeprefix("version=")) for s in found]
    return max((v for v in versions if before is None or v < before), default=None)


def mark_version(spark: SparkSession, path: str, version: int) -> None:
    """Note that a version is done, without rows."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/version={version:010d}/_SUCCESS")
    mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(mark, True).close()


def read_version(
    spark: SparkSession, path: str, schema: StructType, before: int | None = None
) -> DataFrame | None:
    version = current_version(spark, path, before)
    return None if version is None else spark.read.schema(schema).parquet(f"{path}/version={version:010d}")


def replace_snapshot(df: DataFrame, path: str) -> int:
    """Publish a new version of a snapshot that may be computed from the current one."""
    version = (current_version(df.sparkSession, path) or 0) + 1
    write_version(df, path, version)
    return version
