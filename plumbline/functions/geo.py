"""Positions, and position tests (documented only, off by default)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from plumbline.config import LOCATION_BBOX, LOCATION_RANGE_M
from plumbline.schema import FAIL, GOOD, MISSING, SUSPECT

EARTH_RADIUS_M = 6371000.0


def with_position(df: DataFrame) -> DataFrame:
    """Add ``position_latitude`` and ``position_longitude``: the station's position, else the cast's, each by itself."""
    return df.withColumns({f"position_{c}": F.coalesce(f"station_{c}", c) for c in ("latitude", "longitude")})


def distance_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance (haversine)."""
    dlat, dlon = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    h = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(h))


def location_flag(
    lat: Column, lon: Column, station_lat: Column, station_lon: Column,
    range_m: float = LOCATION_RANGE_M, bbox: tuple[float, float, float, float] = LOCATION_BBOX,
) -> Column:
    """MISSING without a position, FAIL outside the box, SUSPECT farther than range_m from the station."""
    west, south, east, north = bbox
    far = distance_m(lat, lon, station_lat, station_lon) > range_m
    return (
        F.when(lat.isNull() | lon.isNull(), MISSING)
        .when(~lat.between(south, north) | ~lon.between(west, east), FAIL)
        .when(far, SUSPECT)
        .otherwise(GOOD)
    )
