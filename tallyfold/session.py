"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tallyfold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on; ``conf`` wins over them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        # Call-site capture costs milliseconds per column expression and only feeds error texts.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session that names none (a test) gets a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyfold-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), "tallyfold", f"{name}-{uuid.uuid4().hex}")


#: Shuffle files of a finished query go at once, not when the driver happens to collect its garbage.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame, path: str) -> DataFrame:
    conf = df.sparkSession.conf
    # Set once and kept: to take it back after each write would undo it for another thread's write.
    if conf.get(_DROP_SHUFFLES, "false") != "true":
        conf.set(_DROP_SHUFFLES, "true")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table: what follows reads it instead of computing it again.

    It survives lost executors, which a cached frame does not.
    """
    return _written(df, scratch_path(df.sparkSession, name))


def drop_path(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def partition_name(spark: SparkSession, column: str, value: str | None) -> str:
    """Directory name of a partition value as Spark writes it: escaped, null under its own name."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return names.getPartitionPathString(column, value)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Like :func:`staged` for the length of a job; its tables are dropped at the end."""
    paths: list[str] = []

    def stage(df: DataFrame, name: str) -> DataFrame:
        paths.append(scratch_path(spark, name))
        return _written(df, paths[-1])

    try:
        yield stage
    finally:
        for path in paths:
            drop_path(spark, path)
