"""Distances on a sphere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres. The inner term is held in [0, 1], so rounding cannot push asin out of range."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), a))))
