"""Distances between coordinates in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
# Rough metres per degree used to turn a radius into degrees.
METRES_PER_DEGREE = 111_000.0


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle distance in metres."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlng = F.radians(lng2 - lng1) / 2
    a = F.pow(F.sin(half_dlat), 2.0) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_dlng), 2.0)
    return F.asin(F.sqrt(a)) * (2.0 * EARTH_RADIUS_M)


def degree_distance(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Plain Euclidean distance in degrees."""
    dlat, dlng = lat2 - lat1, lng2 - lng1
    return F.sqrt(dlat * dlat + dlng * dlng)
