"""Point density on map pixels."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..functions.scalars import ColumnLike, as_col
from ..session import materialize
from .joins import attach_scalars

# Radius, blur and least opacity of the map's heat layer, and its zoom.
HEAT_RADIUS = 30
HEAT_BLUR = 20
HEAT_MIN_OPACITY = 0.5
MAP_ZOOM = 10

#: Farthest latitude of the square map, and how many zooms one aggregation of a pyramid gives.
MAP_LATITUDE = 85.0511287798066
ZOOMS_A_PASS = 6


def extent(df: DataFrame, lat: ColumnLike, lon: ColumnLike) -> DataFrame:
    """Bounding box, number of points and centroid."""
    lat, lon = as_col(lat), as_col(lon)
    return df.agg(
        F.min(lat).alias("min_lat"),
        F.max(lat).alias("max_lat"),
        F.min(lon).alias("min_lon"),
        F.max(lon).alias("max_lon"),
        F.avg(lat).alias("mean_lat"),
        F.avg(lon).alias("mean_lon"),
        F.count("*").alias("points"),
    )


def web_mercator(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Map coordinates in metres."""
    return df.withColumns({"mx": geo.mercator_x(lon), "my": geo.mercator_y(lat)})


def tile_pixel(df: DataFrame, lat: str, lon: str, zoom: int = MAP_ZOOM) -> DataFrame:
    """Tile numbers and world pixel of each point."""
    px, py = F.floor(geo.pixel_x(lon, zoom)), F.floor(geo.pixel_y(lat, zoom))
    return df.withColumns({"px": px, "py": py}).withColumns(
        {
            "tile_x": F.floor(F.col("px") / geo.TILE_PIXELS),
            "tile_y": F.floor(F.col("py") / geo.TILE_PIXELS),
        }
    )


def heat_cells(df: DataFrame, lat: str, lon: str, zoom: int = MAP_ZOOM, cell_px: int = 1) -> DataFrame:
    """Points per square cell of pixels."""
    placed = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
        F.floor(geo.pixel_x(lon, zoom) / cell_px).alias("cx"),
        F.floor(geo.pixel_y(lat, zoom) / cell_px).alias("cy"),
    )
    return placed.groupBy("cx", "cy").agg(F.count("*").alias("points"))


def heat_pyramid(
    df: DataFrame, lat: str, lon: str, finest: int = 18, coarsest: int = 0, cell_px: int = geo.TILE_PIXELS
) -> DataFrame:
    """Points per cell at every zoom from ``finest`` to ``coarsest``: zoom, cx, cy, points.

    The points are read once, for the finest zoom. Coarser zooms are sums of finer cells, which are halved per zoom: each
    pass copies the cells it starts from, not the points, once for each of its ZOOMS_A_PASS zooms, and the last of these starts the
    next pass. Cells are tiles unless ``cell_px`` says otherwise. Points off the map count in the cell at its border; null coordinates are left out.
    """
    if not 0 <= coarsest <= finest:
        raise ValueError("zooms go from finest down to coarsest, at least 0")

    def cell(c: Column) -> Column:
        last = F.floor(F.lit((geo.TILE_PIXELS * 2**finest - 1) / cell_px))
        return F.greatest(F.least(F.floor(c / cell_px), last), F.lit(0).cast("bigint"))

    within = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
        F.greatest(F.least(F.col(lat), F.lit(MAP_LATITUDE)), F.lit(-MAP_LATITUDE)).alias("lat"),
        F.greatest(F.least(F.col(lon), F.lit(180.0)), F.lit(-180.0)).alias("lon"),
    )
    placed = within.select(cell(geo.pixel_x("lon", finest)).alias("cx"), cell(geo.pixel_y("lat", finest)).alias("cy"))
    top = materialize(placed.groupBy("cx", "cy").agg(F.count("*").alias("points")))
    levels, zoom = top.select(F.lit(finest).alias("zoom"), "cx", "cy", "points"), finest
    while zoom > coarsest:
        down = min(ZOOMS_A_PASS, zoom - coarsest)
        copies = top.select("cx", "cy", "points", F.explode(F.sequence(F.lit(1), F.lit(down))).alias("down"))
        halved = copies.groupBy(
            (F.lit(zoom) - F.col("down")).alias("zoom"),
            F.call_function("shiftright", F.col("cx"), F.col("down")).alias("cx"),
            F.call_function("shiftright", F.col("cy"), F.col("down")).alias("cy"),
        ).agg(F.sum("points").alias("points"))
        halved = materialize(halved)
        levels, zoom = levels.unionByName(halved), zoom - down
        top = halved.where(F.col("zoom") == zoom)
    return levels


def kernel_offsets(radius: float, blur: float, cell_px: int) -> list[tuple[int, int, float]]:
    """Neighbour cells within radius + blur pixels: full weight up to the radius, then a
    linear fall to 0."""
    reach = int((radius + blur) // cell_px)
    out = []
    for dx in range(-reach, reach + 1):
        for dy in range(-reach, reach + 1):
            distance = cell_px * math.hypot(dx, dy)
            weight = 1.0 if distance <= radius else 1.0 - (distance - radius) / blur if blur else 0.0
            if weight > 0:
                out.append((dx, dy, weight))
    return out


def heat_surface(
    cells: DataFrame, radius: float = HEAT_RADIUS, blur: float = HEAT_BLUR, cell_px: int = 1
) -> DataFrame:
    """Each cell spread over its neighbours.

    A fixed list of offsets is exploded per occupied cell and summed up inside the task
    first; the number of cells is bounded by the map's pixels, whatever the number of points.
    """
    offsets = kernel_offsets(radius, blur, cell_px)
    # One compact literal in place of thousands of struct expressions.
    dx = F.split(F.lit(",".join(str(o[0]) for o in offsets)), ",").cast("array<int>")
    dy = F.split(F.lit(",".join(str(o[1]) for o in offsets)), ",").cast("array<int>")
    w = F.split(F.lit(",".join(repr(o[2]) for o in offsets)), ",").cast("array<double>")
    spread = cells.select(
        "cx", "cy", "points", F.inline(F.arrays_zip(dx.alias("dx"), dy.alias("dy"), w.alias("w")))
    )
    return spread.groupBy((F.col("cx") + F.col("dx")).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy")).agg(
        F.sum(F.col("points") * F.col("w")).alias("weight")
    )


def heat_opacity(surface: DataFrame, min_opacity: float = HEAT_MIN_OPACITY) -> DataFrame:
    """Weight relative to the greatest weight, raised to the least opacity."""
    scaled = attach_scalars(surface, surface, _top=F.max("weight"))
    opacity = F.greatest(F.col("weight") / F.col("_top"), F.lit(float(min_opacity)))
    return scaled.withColumn("opacity", opacity).drop("_top")
