"""Great-circle distance and the grid cells used to join points by distance."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0
METRES_PER_MILE = 1609.34
METRES_PER_DEGREE = math.pi * EARTH_RADIUS_M / 180.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dlat = F.radians(lat2 - lat1) / 2
    dlon = F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(dlat), F.lit(2)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), F.lit(2))
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def cell_step(metres: float) -> tuple[float, int]:
    """Cell size in degrees for a radius, and how many such cells go round the globe."""
    around = max(1, int(360.0 // (metres / METRES_PER_DEGREE)))
    return 360.0 / around, around


def cell_lat(lat: Column, step: float) -> Column:
    return F.floor((lat + 90.0) / step).cast("long")


def cell_lon(lon: Column, step: float, around: int) -> Column:
    return F.pmod(F.floor((lon + 180.0) / step).cast("long"), F.lit(around).cast("long"))


def covering_cells(lat: Column, lon: Column, metres: float) -> Column:
    """Array of (cell_lat, cell_lon) that a circle can touch; wider in longitude near a pole."""
    step, around = cell_step(metres)
    reach = metres / METRES_PER_DEGREE * 1.001
    shrink = F.greatest(F.cos(F.radians(F.least(F.abs(lat) + reach, F.lit(90.0)))), F.lit(1e-9))
    reach_lon = F.least(F.lit(reach) / shrink, F.lit(180.0))
    rows = F.sequence(cell_lat(lat - reach, step), cell_lat(lat + reach, step))
    first = F.floor((lon - reach_lon + 180.0) / step).cast("long")
    last = F.least(F.floor((lon + reach_lon + 180.0) / step).cast("long"), first + around - 1)
    cols = F.sequence(first, last)
    return F.flatten(
        F.transform(
            rows,
            lambda r: F.transform(
                cols,
                lambda c: F.struct(
                    r.alias("cell_lat"),
                    F.pmod(c, F.lit(around).cast("long")).alias("cell_lon"),
                ),
            ),
        )
    )
