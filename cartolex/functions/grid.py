"""The grid of raster tiles: floors, names and the tiles that a bounding box touches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import TILE_DEGREES


def tile_floor(value: Column, size: int = TILE_DEGREES) -> Column:
    """The grid line at or below a coordinate, also where rounding would lift a tiny negative one to zero."""
    line = F.floor(value / size) * size
    return F.when(line > value, line - size).when(line + size <= value, line + size).otherwise(line).cast("int")


def upper_line(low: Column, high: Column, size: int = TILE_DEGREES) -> Column:
    """The last grid line of a range: one that ends on a line does not enter the next tile unless it is a point."""
    line = tile_floor(high, size)
    return F.when((line == high) & (high > low), line - size).otherwise(line)


def tile_name(lat: Column, lon: Column) -> Column:
    """`N48E006` for the tile whose south-west corner is at 48, 6."""
    side = lambda v, plus, minus, width: F.concat(F.when(v >= 0, F.lit(plus)).otherwise(F.lit(minus)), F.lpad(F.abs(v).cast("string"), width, "0"))
    return F.concat(side(lat, "N", "S", 2), side(lon, "E", "W", 3))


def tile_bounds(lat: Column, lon: Column, size: int = TILE_DEGREES) -> Column:
    """(west, south, east, north) of the tile with this south-west corner."""
    d = lambda c: c.cast("double")
    return F.struct(d(lon).alias("west"), d(lat).alias("south"), d(lon + size).alias("east"), d(lat + size).alias("north"))


def tile_file(lat: Column, lon: Column, version: str = "v200", year: int = 2021, root: str = "") -> Column:
    """The path of a tile's file under `root`: its name in a folder of the product's version and year."""
    base = f"{root.rstrip('/')}/" if root else ""
    return F.concat(F.lit(f"{base}{version}/{year}/map/ESA_WorldCover_10m_{year}_{version}_"), tile_name(lat, lon), F.lit("_Map.tif"))


def cell_place(cell: Column, width: int) -> tuple[Column, Column]:
    """(row, column) of a cell number in a raster of this width."""
    return F.floor(cell / width).cast("long"), F.pmod(cell, F.lit(width))


def cell_number(row: Column, column: Column, width: int) -> Column:
    return row.cast("long") * width + column


def map_place(row: Column, column: Column, x0: float, y0: float, dx: float, dy: float) -> tuple[Column, Column]:
    """(x, y) of a place given in rows and columns, which may be fractions; the origin is the north-west corner."""
    return x0 + column * dx, y0 - row * dy


def pixel_place(x: Column, y: Column, x0: float, y0: float, dx: float, dy: float) -> tuple[Column, Column]:
    """(row, column) of a map place, as fractions."""
    return (y0 - y) / dy, (x - x0) / dx


def missing(tiles: DataFrame, catalog: DataFrame) -> DataFrame:
    """Rows of `tiles` (tile_lat, tile_lon, ...) whose tile is not in the catalog."""
    return tiles.join(catalog.select("tile_lat", "tile_lon"), ["tile_lat", "tile_lon"], "left_anti")


def tiles_for_bbox(west: Column, south: Column, east: Column, north: Column, size: int = TILE_DEGREES, strict: bool = False) -> Column:
    """Sorted array of (lat, lon) of the tiles that a box touches; empty for null, inverted or not finite boxes.

    `strict` raises for an inverted box.
    """
    ok = (west <= east) & (south <= north) & (west >= -180) & (east <= 180) & (south >= -90) & (north <= 90)
    line = lambda low, high: F.sequence(tile_floor(low, size), F.greatest(tile_floor(low, size), upper_line(low, high, size)), F.lit(size))
    pairs = F.flatten(F.transform(line(south, north), lambda a: F.transform(line(west, east), lambda b: F.struct(a.alias("lat"), b.alias("lon")))))
    some = F.when(((west > east) | (south > north)), F.raise_error(F.lit("inverted box"))).when(ok, pairs) if strict else F.when(ok, pairs)
    return some.otherwise(F.array().cast("array<struct<lat:int,lon:int>>"))
