"""Map projection and tile arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import ColumnLike, as_col

# Sphere radius of EPSG:3857 in metres, pixels per map tile.
EARTH_RADIUS = 6378137.0
TILE_PIXELS = 256


def mercator_x(lon: ColumnLike) -> Column:
    return F.lit(EARTH_RADIUS) * F.radians(as_col(lon))


def mercator_y(lat: ColumnLike) -> Column:
    return F.lit(EARTH_RADIUS) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(as_col(lat)) / 2))


def pixel_x(lon: ColumnLike, zoom: int) -> Column:
    """Pixel column in the world image of a zoom level, counted from the west."""
    world = F.lit(float(TILE_PIXELS * 2**zoom))
    return (F.lit(0.5) + mercator_x(lon) / F.lit(2 * math.pi * EARTH_RADIUS)) * world


def pixel_y(lat: ColumnLike, zoom: int) -> Column:
    """Pixel row in the world image of a zoom level, counted from the north."""
    world = F.lit(float(TILE_PIXELS * 2**zoom))
    return (F.lit(0.5) - mercator_y(lat) / F.lit(2 * math.pi * EARTH_RADIUS)) * world
