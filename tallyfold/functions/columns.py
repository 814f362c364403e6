"""Column expressions for text, dates and nulls."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def has_prefix(column: ColumnOrName, prefixes: Iterable[str]) -> Column:
    """True when the text starts with one of the prefixes."""
    tests = [as_column(column).startswith(prefix) for prefix in prefixes]
    return reduce(Column.__or__, tests, F.lit(False))


def prefix_in(column: ColumnOrName, prefixes: Iterable[str], width: int = 2) -> Column:
    """True when the first ``width`` characters are in the list."""
    return F.substring(as_column(column), 1, width).isin(list(prefixes))


def any_null(columns: Iterable[str]) -> Column:
    return reduce(Column.__or__, [F.col(name).isNull() for name in columns], F.lit(False))


def both_present(latitude: ColumnOrName, longitude: ColumnOrName) -> Column:
    """Neither coordinate is null or NaN."""
    lat, lon = as_column(latitude), as_column(longitude)
    return lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)


def inside_box(
    latitude: ColumnOrName, longitude: ColumnOrName, lat_range: tuple[float, float], lon_range: tuple[float, float]
) -> Column:
    """Strictly inside the box: points on the edge are out."""
    lat, lon = as_column(latitude), as_column(longitude)
    return (lat > lat_range[0]) & (lat < lat_range[1]) & (lon > lon_range[0]) & (lon < lon_range[1])


def null_if(column: ColumnOrName, sentinel: object) -> Column:
    return F.nullif(as_column(column), F.lit(sentinel))


def fips_text(column: ColumnOrName) -> Column:
    """County code as five characters, whether it arrives as a number or as text."""
    return F.lpad(F.trim(as_column(column).cast("string")), 5, "0")


def before_comma(column: ColumnOrName) -> Column:
    return F.split_part(as_column(column), F.lit(","), F.lit(1))


def strip_dots(column: ColumnOrName) -> Column:
    return F.btrim(as_column(column), F.lit("."))


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.lower() for name in df.columns])


def scientific(column: ColumnOrName) -> Column:
    """Two decimals and an exponent, as in 1.25e-03."""
    return F.format_string("%.2e", as_column(column).cast("double"))


def ratio(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """Share as a double; null where the whole is zero or missing."""
    return as_column(part).cast("double") / F.nullif(as_column(whole).cast("double"), F.lit(0.0))


def cast_all(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns; text that does not parse becomes null instead of failing the job."""
    return df.select(
        *[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )


def parse_date(column: ColumnOrName, pattern: str = "yyyyMMdd") -> Column:
    return F.try_to_timestamp(as_column(column), F.lit(pattern)).cast("date")


def iso_date(column: ColumnOrName) -> Column:
    """Date of an ISO timestamp text such as 2020-03-01T00:00:00.000."""
    return F.substring(as_column(column), 1, 10).try_cast("date")


def days_before(column: ColumnOrName, days: int) -> Column:
    return F.date_sub(as_column(column), days)


def surrogate_id(*columns: ColumnOrName) -> Column:
    """Id that depends on the natural key alone, so it survives reloads and repartitioning.

    Each column contributes a null marker too: null and '' get different ids.
    """
    parts: list[Column] = []
    for column in columns:
        parts += [as_column(column).isNull(), F.coalesce(as_column(column).cast("string"), F.lit(""))]
    return F.xxhash64(*parts)


def seeded_id(seed: int, *columns: ColumnOrName) -> Column:
    """:func:`surrogate_id` for seed 0, another id of the same kind for any other."""
    first = surrogate_id(*columns)
    return first if seed == 0 else F.xxhash64(F.lit(seed), first, *[F.coalesce(as_column(c).cast("string"), F.lit("")) for c in columns])


def number_or_null(name: str) -> Column:
    """The column with NaN as null."""
    return F.when(~F.isnan(F.col(name).cast("double")), F.col(name))
