"""Great-circle distance (M1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUE: mean Earth radius in statute miles used for trip distances.
EARTH_RADIUS_MILES = 3958.8


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def haversine_miles(lat1, lon1, lat2, lon2, digits: int = 2) -> Column:
    """Haversine distance in miles rounded to ``digits`` (a JVM expression)."""
    phi1, phi2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    dphi = F.radians(_col(lat2) - _col(lat1))
    dlmb = F.radians(_col(lon2) - _col(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(dlmb / 2), 2)
    return F.round(F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(a)), digits)


def add_trip_distance(df: DataFrame,
                      start_lat: str = "start_station_latitude",
                      start_lon: str = "start_station_longitude",
                      end_lat: str = "end_station_latitude",
                      end_lon: str = "end_station_longitude",
                      out: str = "distance") -> DataFrame:
    """All input columns preserved, plus nullable double ``distance``."""
    return df.withColumn(out, haversine_miles(start_lat, start_lon, end_lat, end_lon)
                         .cast("double"))
