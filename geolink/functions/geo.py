"""Column expressions on coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from geolink.functions.keys import _col, finite

# Fixed value: mean Earth radius in km.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km; null when any coordinate is null or NaN."""
    lat1, lon1, lat2, lon2 = (finite(c) for c in (lat1, lon1, lat2, lon2))
    half_chord = (
        F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    )
    # Antipodal points can exceed 1 in the last bit, where the arc sine is undefined. LEAST skips
    # nulls, hence the guard.
    root = F.sqrt(half_chord)
    return F.when(root.isNotNull(), 2 * EARTH_RADIUS_KM * F.asin(F.least(F.lit(1.0), root)))


def rounded(c, digits: int = 6) -> Column:
    """Half-even rounding, which identifies coordinates that are the same point."""
    return F.bround(_col(c), digits)


def both_present(lat, lon) -> Column:
    """True where latitude and longitude are both known; never null."""
    return _col(lat).isNotNull() & _col(lon).isNotNull()


def farther_than(distance, km: float) -> Column:
    """Distance flag; an unknown distance is not far."""
    return F.coalesce(_col(distance) > F.lit(float(km)), F.lit(False))


def usable_point(lat: Column, lon: Column) -> Column:
    """Both coordinates as one struct, null unless both are known."""
    return F.when(both_present(lat, lon), F.struct(lat.alias("lat"), lon.alias("lon")))
