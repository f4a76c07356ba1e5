"""Coordinates: web Mercator to degrees, and flat-earth distances."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M, KM_PER_DEGREE = 6378137.0, 111.0


def mercator_to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude in degrees of EPSG:3857 metres; the origin is exactly (0, 0)."""
    lat = F.degrees(2 * F.atan(F.exp(y / EARTH_M)) - math.pi / 2)
    return F.degrees(x / EARTH_M), F.when(y == 0, F.lit(0.0)).otherwise(lat)


def flat_km(lat: Column, lon: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km on a plane tangent at the first point."""
    return F.hypot((lat2 - lat) * KM_PER_DEGREE, (lon2 - lon) * KM_PER_DEGREE * F.cos(F.radians(lat)))


def four_decimals(x: Column) -> Column:
    """The ten-thousandths nearest to a double's exact value, as a whole number; a tie goes to the even one.

    The part behind the point is split in two, so that both products with 20,000 are exact: a text such as 53.00005 stands
    for a double that lies above or below the middle, and is rounded by that.  Null for nulls and what is no finite number.
    """
    size = F.abs(x)
    whole = F.floor(size)
    rest = size - whole
    high = F.floor(rest * 2.0**26) / F.lit(2.0**26)
    n = F.floor(rest * 10_000)
    beyond = (high * 20_000 - (2 * n + 1)) + (rest - high) * 20_000
    up = F.when(beyond > 0, 1).when(beyond < 0, 0).otherwise(n % 2)
    return F.when(size < 1e9, F.signum(x).cast("bigint") * (whole * 10_000 + n + up))
