"""True wind and ship velocity as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KNOT_M_S = 1852.0 / 3600.0
EARTH_RADIUS_M = 6_371_000.0


def _degrees_from_north(east: Column, north: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))


def true_wind(
    relative_direction: Column, relative_speed: Column, heading: Column, course: Column, ship_speed: Column
) -> tuple[Column, Column]:
    """(direction the wind comes from, speed) out of wind relative to the bow and ship motion.

    `ship_speed` is in the unit of `relative_speed`.
    """
    apparent = F.radians(relative_direction + heading)
    course_rad = F.radians(course)
    east = ship_speed * F.sin(course_rad) - relative_speed * F.sin(apparent)
    north = ship_speed * F.cos(course_rad) - relative_speed * F.cos(apparent)
    return _degrees_from_north(-east, -north), F.hypot(east, north)


def velocity_between(
    lat_a: Column, lon_a: Column, us_a: Column, lat_b: Column, lon_b: Column, us_b: Column
) -> tuple[Column, Column]:
    """(course in degrees, speed in knots) of a straight run from fix a to fix b.

    Equirectangular at the mean latitude; the longitude step is taken the short
    way round, so a run across the antimeridian is not a lap of the globe.
    """
    seconds = (us_b - us_a) / F.lit(1e6)
    mean_lat = F.radians((lat_a + lat_b) / 2)
    step_lat = F.radians(lat_b - lat_a)
    step_lon = F.radians(F.pmod(lon_b - lon_a + 180.0, F.lit(360.0)) - 180.0)
    east = EARTH_RADIUS_M * F.cos(mean_lat) * step_lon / seconds
    north = EARTH_RADIUS_M * step_lat / seconds
    return _degrees_from_north(east, north), F.hypot(east, north) / KNOT_M_S
