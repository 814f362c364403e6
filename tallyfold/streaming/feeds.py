"""The batch jobs driven by files that arrive.

Files come in numbered directories, ``seq=<n>/...``; a directory is complete when it becomes visible
(written elsewhere, then renamed). Replaying a batch writes the same tables again. The last number
applied is kept beside the checkpoint: a directory with a smaller number comes too late, since what
follows it is in place already, and is refused.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyfold import schemas
from tallyfold.operators.incremental import attach_location_id
from tallyfold.operators.joins import split_matched
from tallyfold.plans.cases import next_batch
from tallyfold.plans.ledger import load_counts
from tallyfold.plans.weather import apply_deltas_to_path, clean_deltas
from tallyfold.sinks.files import current_version, mark_version
from tallyfold.sources.files import DELTA_OPERATIONS

DELTA_STREAM_SCHEMA = T.StructType([*schemas.WEATHER_RAW, *schemas.columns("seq int, op string")])
CASE_STREAM_SCHEMA = T.StructType([*schemas.CASES_CUMULATED, *schemas.columns("seq int")])


def _run(
    files: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    """Hand the rows of each numbered directory to ``handle``, in order, until none is left."""
    applied = checkpoint.rstrip("/") + ".applied"

    def each(batch: DataFrame, _: int) -> None:
        batch.persist()
        try:
            # One number per directory that arrived, not data.
            for row in batch.select("seq").distinct().orderBy("seq").collect():
                last = current_version(batch.sparkSession, applied)
                if last is not None and row.seq < last:
                    raise ValueError(f"directory seq={row.seq} came after seq={last} was applied")
                handle(batch.where(F.col("seq") == row.seq).drop("seq"), row.seq)
                mark_version(batch.sparkSession, applied, row.seq)
        finally:
            batch.unpersist()

    writer = files.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def weather_delta_stream(
    spark: SparkSession, incoming: str, fact_path: str, selected: DataFrame, checkpoint: str
) -> StreamingQuery:
    """Apply delta files named ``seq=<n>/op=<delete|insert|update>/*.csv`` to the stored fact."""

    def apply(rows: DataFrame, _: int) -> None:
        parts = {op: rows.where(F.col("op") == op).drop("op") for op in DELTA_OPERATIONS}
        apply_deltas_to_path(spark, fact_path, clean_deltas(parts, selected))

    files = spark.readStream.schema(DELTA_STREAM_SCHEMA).option("header", False).csv(incoming)
    return _run(files, apply, checkpoint)


def case_batch_stream(
    spark: SparkSession, incoming: str, locations: DataFrame, daily_path: str, snapshot_path: str, checkpoint: str
) -> StreamingQuery:
    """Load recent cumulated counts named ``seq=<n>/*.csv``, n from 1, as batch n."""

    def load(rows: DataFrame, number: int) -> None:
        next_batch(spark, rows, locations, daily_path, snapshot_path, number)

    files = spark.readStream.schema(CASE_STREAM_SCHEMA).option("header", True).csv(incoming)
    return _run(files, load, checkpoint)


def correction_stream(
    spark: SparkSession, incoming: str, locations: DataFrame, ledger_path: str, checkpoint: str
) -> StreamingQuery:
    """Load cumulated counts named ``seq=<n>/*.csv``, with new, inserted and revised days, into the ledger.

    A directory is a batch of the ledger, so one that is replayed after a failure counts once.
    """

    def load(rows: DataFrame, number: int) -> None:
        known, _ = split_matched(attach_location_id(rows, locations), "location_id")
        load_counts(spark, ledger_path, known, f"seq {number}")

    files = spark.readStream.schema(CASE_STREAM_SCHEMA).option("header", True).csv(incoming)
    return _run(files, load, checkpoint)
