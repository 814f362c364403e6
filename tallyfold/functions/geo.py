"""Column expressions on the sphere. Latitudes and longitudes are degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyfold.fixed_values import EARTH_RADIUS_KM
from tallyfold.functions.columns import ColumnOrName, as_column


def half_angle(lat1: str, lon1: str, lat2: str, lon2: str) -> Column:
    """Half the central angle between two points in radians; the unit in which cut-offs are given.

    Takes column names. Rounding may lift the haversine term above 1 for opposite points.
    """
    term = (
        f"least(pow(sin((radians({lat1}) - radians({lat2})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon1} - {lon2}) / 2), 2), 1D)"
    )
    return F.expr(f"atan2(sqrt({term}), sqrt(1 - {term}))")


def distance_in_cutoff_unit(angle: ColumnOrName) -> Column:
    return as_column(angle) * EARTH_RADIUS_KM


def distance_km(angle: ColumnOrName) -> Column:
    """True great-circle distance of a half angle."""
    return as_column(angle) * (2 * EARTH_RADIUS_KM)
