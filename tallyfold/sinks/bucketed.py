"""Tables in buckets of a key, so that joins on it find their rows in place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET_KEY = "bucket_key"


def bucket_key(keys: Sequence[str]) -> Column:
    """The key columns as one text that is never null, under which two nulls are equal and differ from ''."""
    return F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in keys]), {"ignoreNullFields": "false"})


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int | None = None) -> None:
    """Write rows with their ``bucket_key`` as the external table ``name``, sorted inside each bucket.

    Spark moves the unbucketed side of a join only when there are at least as many buckets as shuffle
    partitions, which is the default. A hot key makes its bucket large; keys of a fact that has one
    row a key, as observations have, cannot.
    """
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn(BUCKET_KEY, bucket_key(keys))
    count = max(buckets or 0, wanted)
    # One task a bucket, hence one file a bucket.
    rows = keyed.repartition(count, BUCKET_KEY)
    rows.write.mode("overwrite").bucketBy(count, BUCKET_KEY).sortBy(BUCKET_KEY).option("path", path).saveAsTable(name)


def open_bucketed(spark: SparkSession, name: str, path: str, schema: StructType, buckets: int) -> DataFrame:
    """Make a table written by another session known to this one; its files stay as they are."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*schema])
    spark.sql(
        f"CREATE TABLE {name} ({columns}, `{BUCKET_KEY}` string) USING parquet "
        f"CLUSTERED BY ({BUCKET_KEY}) SORTED BY ({BUCKET_KEY}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
