"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: mean earth radius in metres.
EARTH_RADIUS_M = 6_371_000


def great_circle_m(lat_a: str, lon_a: str, lat_b: str, lon_b: str, clamp: bool = True) -> Column:
    """Metres between two points by the spherical law of cosines, 2 decimals.

    Rounding can push the cosine just above 1, where ``acos`` is NaN and every
    later ``<`` test silently drops the row; ``clamp`` holds it in [-1, 1].
    Coordinates may be text; text that is no number gives NULL.
    """
    phi_a, lam_a, phi_b, lam_b = (F.radians(F.col(c).try_cast("double")) for c in (lat_a, lon_a, lat_b, lon_b))
    cosine = F.cos(phi_a) * F.cos(phi_b) * F.cos(lam_b - lam_a) + F.sin(phi_a) * F.sin(phi_b)
    if clamp:
        known = cosine.isNotNull()
        cosine = F.when(known, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine)))
    return F.round(F.lit(EARTH_RADIUS_M) * F.acos(cosine), 2)
