"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0  # fixed value: distances depend on it


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km between two points in degrees; NULL if any part is NULL.

    Rounding can push the haversine slightly above 1, where ``asin`` is NaN and
    NaN compares greater than every speed limit. ``least`` would skip NULLs and
    invent a distance for unknown places, hence the explicit ``when``.
    """
    half_lat = F.sin(F.radians((lat2 - lat1) / 2))
    half_lon = F.sin(F.radians((lon2 - lon1) / 2))
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(h > 1.0, 1.0).otherwise(h)))
