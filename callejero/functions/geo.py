"""Great-circle distance and the box that bounds a radius."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from callejero.constants import EARTH_RADIUS_KM


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km on a sphere, in the numerically safe atan2 form."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dphi = (phi2 - phi1) / 2
    half_dlambda = (F.radians(lon2) - F.radians(lon1)) / 2
    chord = (
        F.sin(half_dphi) * F.sin(half_dphi)
        + F.cos(phi1) * F.cos(phi2) * F.sin(half_dlambda) * F.sin(half_dlambda)
    )
    return EARTH_RADIUS_KM * 2 * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def in_bounding_box(lat: Column, lon: Column, centre: tuple[float, float], km: float) -> Column:
    """Cheap test that holds for every point within ``km`` of ``centre``.

    Plain comparisons on the stored columns, so Parquet can skip row groups.
    The longitude test is dropped where the box would reach a pole or the
    antimeridian.
    """
    margin = km / EARTH_RADIUS_KM * 1.0001
    dlat = math.degrees(margin)
    test = lat.between(centre[0] - dlat, centre[0] + dlat)
    widest = math.cos(math.radians(centre[0]))
    if abs(centre[0]) + dlat < 89 and math.sin(margin) < widest:
        dlon = math.degrees(math.asin(math.sin(margin) / widest)) * 1.0001
        if abs(centre[1]) + dlon < 180:
            test = test & lon.between(centre[1] - dlon, centre[1] + dlon)
    return test
