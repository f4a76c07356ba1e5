"""Radius join with a nearest-neighbour fallback, over grid cells."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanworks.functions.geo import KM_PER_DEGREE, flat_km, four_decimals

RADIUS_KM, FALLBACK_KM, CELL = 0.5, 8.0, 0.01


def _celled(points: DataFrame, cell: float, rings_lat: int = 0, rings_lon: int = 0) -> DataFrame:
    """Points with the grid cells that they can reach."""
    out = points
    for name, c, rings in (("_y", "lat", rings_lat), ("_x", "lon", rings_lon)):
        at = F.floor(F.col(c) / cell)
        out = out.withColumn(name, F.explode(F.sequence(at - rings, at + rings)) if rings else at)
    return out


def positions(pins: DataFrame, areas: DataFrame, radius_km: float, cell: float, max_abs_lat: float = 60.0) -> DataFrame:
    """(lat, lon, lat2, lon2, km) for the positions of areas within a radius of a position of pins, each pair once.

    An equi-join on grid cells with the distance as residual: positions of areas go to all cells around
    them that the radius can reach, so no pair outside neighbouring cells is formed.  Points at one place are compared once.
    """
    rings_lat = math.ceil(radius_km / (KM_PER_DEGREE * cell))
    rings_lon = math.ceil(radius_km / (KM_PER_DEGREE * math.cos(math.radians(max_abs_lat)) * cell))
    left = _celled(pins.select("lat", "lon").distinct(), cell)
    right = _celled(areas.select("lat", "lon").distinct(), cell, rings_lat, rings_lon).withColumnsRenamed({"lat": "lat2", "lon": "lon2"})
    km = flat_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2"))
    return left.join(right, ["_y", "_x"]).withColumn("km", km).where(F.col("km") <= radius_km).select("lat", "lon", "lat2", "lon2", "km")


def _spread(pins: DataFrame, areas: DataFrame, found: DataFrame, digits: int | None = None) -> DataFrame:
    """(pin, area, km) for the pins and areas at the positions that were found; km is rounded before it is in many rows."""
    if digits is not None:
        found = found.withColumn("km", F.round("km", digits))
    there = areas.select("area", F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    return pins.select("pin", "lat", "lon").join(found, ["lat", "lon"]).join(there, ["lat2", "lon2"]).select("pin", "area", "km")


def within(pins: DataFrame, areas: DataFrame, radius_km: float, cell: float, max_abs_lat: float = 60.0, digits: int | None = None) -> DataFrame:
    """(pin, area, km) for areas within a radius of a pin; km is rounded to ``digits``, if given.

    ``pins`` has pin, lat, lon; ``areas`` has area, lat, lon.  :func:`positions` are compared; pins and areas come in at the end.
    """
    return _spread(pins, areas, positions(pins, areas, radius_km, cell, max_abs_lat), digits)


def affected(pins: DataFrame, areas: DataFrame, radius_km: float = RADIUS_KM, fallback_km: float = FALLBACK_KM, cell: float = CELL, digits: int | None = None) -> DataFrame:
    """Areas within the radius; for a pin without any, the nearest within the fallback; else none.

    The fallback runs over coarser cells and only for pins that found nothing; ties go to the smaller area id.  km is rounded to ``digits``, if given.  What is
    found is told by position, so that the areas of pins come in at the end and are never shuffled."""
    points = pins.select("pin", "lat", "lon")
    found = positions(points, areas, radius_km, cell)
    near = _spread(points, areas, found, digits).withColumn("nearest", F.lit(False))
    served = points.join(found.select("lat", "lon").distinct(), ["lat", "lon"]).select("pin")
    alone = points.join(served, "pin", "left_anti")
    first = areas.where(F.col("area").isNotNull()).groupBy(F.col("lat").alias("lat2"), F.col("lon").alias("lon2")).agg(F.min("area").alias("area"))
    best = positions(alone, areas, fallback_km, 10 * cell).join(first, ["lat2", "lon2"]).groupBy("lat", "lon").agg(F.min(F.struct("km", "area")).alias("m"))
    far = alone.join(best, ["lat", "lon"]).groupBy("pin").agg(F.min("m").alias("m"))
    km = F.col("m.km") if digits is None else F.round("m.km", digits)
    return near.union(far.select("pin", "m.area", km, F.lit(True)))


def footprints(pins: DataFrame, areas: DataFrame, **kw) -> DataFrame:
    """:func:`affected` computed once per cell of four decimals, from the pin with the smallest id in it."""
    cells = pins.withColumns({"_la": four_decimals(F.col("lat")), "_lo": four_decimals(F.col("lon"))})
    first = cells.groupBy("_la", "_lo").agg(F.min(F.struct("pin", "lat", "lon")).alias("p")).select("_la", "_lo", "p.pin", "p.lat", "p.lon")
    found = affected(first.select("pin", "lat", "lon"), areas, **kw).withColumnRenamed("pin", "_first")
    shared = first.select("_la", "_lo", F.col("pin").alias("_first")).join(found, "_first")
    return cells.select("pin", "_la", "_lo").join(shared, ["_la", "_lo"]).select("pin", "area", "km", "nearest")
