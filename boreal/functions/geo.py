"""Great-circle distance as a Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: earth radius in km used by the forecast's distance kernel.
EARTH_RADIUS_KM = 6367.0


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """Haversine distance in km between points given in decimal degrees (Columns or numbers)."""
    phi1, phi2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = phi2 - phi1
    dlmb = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(2.0 * radius_km) * F.asin(F.sqrt(a))
