"""Database tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyfold.sources.database import jdbc_options


def write_table(
    df: DataFrame, url: str, table: str, mode: str = "errorifexists", connections: int | None = None, **extra: str
) -> None:
    """Create, overwrite or append to a table, over at most ``connections`` connections."""
    options = jdbc_options(url, table, **extra)
    if connections:
        options["numPartitions"] = str(connections)
    df.write.format("jdbc").mode(mode).options(**options).save()
