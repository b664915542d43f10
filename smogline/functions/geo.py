"""Coordinates, sensor keys and distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from smogline.schema import SENSOR

EARTH_RADIUS_KM = 6371.0


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def haversine_km(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_KM) -> Column:
    lat1, lon1, lat2, lon2 = (_col(c) for c in (lat1, lon1, lat2, lon2))
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = (half_lat * half_lat
             + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon)
    chord = F.least(chord, F.lit(1.0))
    return F.lit(2.0 * radius) * F.atan2(F.sqrt(chord), F.sqrt(F.lit(1.0) - chord))


def round_coord(degrees, places: int = 4) -> Column:
    """Half-even on the scaled binary number, as numpy rounds: 0.03125 becomes 0.0312, but
    41.87125, which scales to slightly more than a half, becomes 41.8713."""
    scale = F.lit(10.0 ** places)
    return F.rint(_col(degrees) * scale) / scale


def sensor_key(columns=SENSOR) -> Column:
    return F.concat_ws("||", *columns)


def _plain(number: Column) -> Column:
    """Decimal text without an exponent for the small magnitudes Spark prints as 5.0E-4."""
    digits = F.rtrim(number.cast("decimal(30,20)").cast("string"), F.lit("0"))
    return F.when((F.abs(number) < 1e-3) & (number != 0), digits).otherwise(number.cast("string"))


def geocode(lat, lon) -> Column:
    """``"lat, lon"``; null when either is missing."""
    return F.concat(_plain(_col(lat)), F.lit(", "), _plain(_col(lon)))
