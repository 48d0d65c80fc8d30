"""Distances and grid cells on latitude/longitude columns in degrees."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from tidemark.functions.types import ColumnLike, as_col

EARTH_KM = 6371.0088


def distance_km(lat: ColumnLike, lon: ColumnLike, point: tuple[float, float]) -> Column:
    """Great-circle distance to a fixed point (haversine)."""
    lat, lon = as_col(lat).cast("double"), as_col(lon).cast("double")
    dlat = F.radians(lat - F.lit(float(point[0]))) / 2
    dlon = F.radians(lon - F.lit(float(point[1]))) / 2
    half = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat)) * math.cos(math.radians(point[0])) * F.sin(dlon) * F.sin(dlon)
    return F.asin(F.sqrt(F.least(F.lit(1.0), half))) * (2 * EARTH_KM)


def distance_between_km(lat: ColumnLike, lon: ColumnLike, other_lat: ColumnLike, other_lon: ColumnLike) -> Column:
    """Great-circle distance of two points, both in columns (haversine)."""
    lat, lon, other_lat, other_lon = (F.radians(as_col(c).cast("double")) for c in (lat, lon, other_lat, other_lon))
    dlat, dlon = F.sin((lat - other_lat) / 2), F.sin((lon - other_lon) / 2)
    return F.asin(F.sqrt(F.least(F.lit(1.0), dlat * dlat + F.cos(lat) * F.cos(other_lat) * dlon * dlon))) * (2 * EARTH_KM)


def space_cell(lat: ColumnLike, lon: ColumnLike, km: float) -> list[Column]:
    """Numbers (x, y, z) of the cube of space that holds a point of the globe. Points within `km` of each other lie in the same or in
    adjacent cubes, at the poles and across the 180th meridian too."""
    lat, lon = (F.radians(as_col(c).cast("double")) for c in (lat, lon))
    side = 2 * math.sin(min(km / EARTH_KM / 2, math.pi / 2)) * 1.000001 + 1e-12  # the chord, on a globe of radius 1
    return [F.floor(v / side).cast("int") for v in (F.cos(lat) * F.cos(lon), F.cos(lat) * F.sin(lon), F.sin(lat))]


def bounding_box(lat: ColumnLike, lon: ColumnLike, point: tuple[float, float], km: float) -> Column:
    """Plain range test that every point within `km` passes, so file statistics can prune.

    The longitude test is left out where the circle reaches a pole or the 180th meridian.
    """
    lat, lon = as_col(lat).cast("double"), as_col(lon).cast("double")
    angle = km / EARTH_KM
    dlat = math.degrees(angle) * 1.000001 + 1e-9
    box = lat.between(point[0] - dlat, point[0] + dlat)
    edge = abs(point[0]) + dlat
    if edge < 90:
        dlon = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(point[0]))))) * 1.000001 + 1e-9
        west, east = point[1] - dlon, point[1] + dlon
        if west >= -180 and east <= 180:
            box = box & lon.between(west, east)
    return box


def grid_cell(value: ColumnLike, origin: float, degrees: float) -> Column:
    """Number of the grid row or column that holds the value."""
    return F.floor((as_col(value).cast("double") - F.lit(origin)) / F.lit(degrees)).cast("bigint")
