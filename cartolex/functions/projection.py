"""Cylindrical equal-area projection of the ellipsoid with standard parallel 30 (Snyder 1987, p. 81) as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The WGS 84 ellipsoid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257223563
ECCENTRICITY_2 = FLATTENING * (2 - FLATTENING)
ECCENTRICITY = math.sqrt(ECCENTRICITY_2)
K0 = math.cos(math.radians(30)) / math.sqrt(1 - ECCENTRICITY_2 * math.sin(math.radians(30)) ** 2)


def authalic_q(lat: Column) -> Column:
    s = F.sin(F.radians(lat))
    es = s * ECCENTRICITY
    return (s / (1 - es * es) - F.log((1 - es) / (1 + es)) / (2 * ECCENTRICITY)) * (1 - ECCENTRICITY_2)


def project(lat: Column, lon: Column) -> tuple[Column, Column]:
    """(x, y) in metres."""
    return F.radians(lon) * (SEMI_MAJOR * K0), authalic_q(lat) * (SEMI_MAJOR / (2 * K0))


def box_area_m2(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Exact area of a box of meridians and parallels."""
    return F.radians(east - west) * (authalic_q(north) - authalic_q(south)) * (SEMI_MAJOR**2 / 2)


def ratio_enclosure(part: Column, whole: Column, error: Column, threshold: float = 0.8) -> Column:
    """(lower, upper, crosses): bounds of part/whole when both may be off by `error`, and whether they enclose the threshold."""
    lower = F.greatest(F.lit(0.0), F.try_divide(part - error, whole + error))
    upper = F.least(F.lit(1.0), F.try_divide(part + error, F.greatest(whole - error, F.lit(0.0))))
    upper = F.coalesce(upper, F.lit(1.0))
    return F.struct(lower.alias("lower"), upper.alias("upper"), ((lower < threshold) & (upper >= threshold)).alias("crosses"))
