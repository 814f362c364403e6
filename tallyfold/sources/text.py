"""Line formats, parsed with column expressions.

The parsers take a frame with one text column ``value``, as ``spark.read.text`` gives it; a comma
in a name does no harm there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.fixed_values import GAZETTEER_HEADER_COLUMNS, STATION_FIELDS, UNKNOWN_ELEVATION
from tallyfold.functions.columns import fips_text, null_if


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path)


def _tokens(line: str = "value") -> Column:
    return F.split(F.trim(F.col(line)), r"\s+")


def fixed_width(lines: DataFrame, fields: list[tuple[str, int, int, str]]) -> DataFrame:
    """Cut fields by column; blanks and unreadable numbers become null. Width 0 runs to the end."""
    columns = []
    for name, start, width, kind in fields:
        text = F.nullif(F.trim(F.substring("value", start, width or 1 << 30)), F.lit(""))
        columns.append((text if kind == "string" else text.try_cast(kind)).alias(name))
    return lines.select(*columns)


def parse_stations(lines: DataFrame) -> DataFrame:
    """Station register by column position; the unknown elevation becomes null."""
    rows = fixed_width(lines, STATION_FIELDS)
    return rows.withColumn("elevation", null_if("elevation", UNKNOWN_ELEVATION))


def parse_stations_by_token(lines: DataFrame) -> DataFrame:
    """Station register split on blanks: five tokens, the rest is the name.

    A line with a blank state shifts; use :func:`parse_stations` where that occurs.
    """
    rows = lines.select(_tokens().alias("t"))
    return rows.select(
        F.get("t", F.lit(0)).alias("station_id"),
        *[F.get("t", F.lit(i)).try_cast("double").alias(n) for i, n in ((1, "latitude"), (2, "longitude"))],
        null_if(F.get("t", F.lit(3)).try_cast("double"), UNKNOWN_ELEVATION).alias("elevation"),
        F.get("t", F.lit(4)).alias("state"),
        F.array_join(F.slice("t", F.lit(6), F.greatest(F.size("t") - 5, F.lit(0))), " ").alias("station_name"),
    )


def parse_gazetteer(lines: DataFrame) -> DataFrame:
    """County gazetteer: state, code, county name of any number of words, coordinates at the end.

    A header line, told by a code that is not a number, is left out.
    """
    rows = lines.select(_tokens().alias("t")).where(F.get("t", F.lit(1)).try_cast("bigint").isNotNull())
    words = F.size("t") - (GAZETTEER_HEADER_COLUMNS - 1)
    return rows.select(
        F.get("t", F.lit(0)).alias("state"),
        F.array_join(F.slice("t", F.lit(4), F.greatest(words, F.lit(0))), " ").alias("county"),
        fips_text(F.get("t", F.lit(1))).alias("fips"),
        F.element_at("t", -2).try_cast("double").alias("latitude"),
        F.element_at("t", -1).try_cast("double").alias("longitude"),
    )
