"""Zonal statistics: how much of every polygon each raster class covers.

The raster stands in square blocks of cells. A polygon is sent to the blocks that its box touches, which makes the
spatial join an equality of (tile, block row, block column); inside, the exact area of polygon and cell is accumulated
from the polygon's edges (published anti-aliasing rasterisers do the same), so the work follows the length of the
outline and the cells of the block. Large polygons spread over many tasks by themselves.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions.grid import tiles_for_bbox
from ..functions.projection import authalic_q

#: Cells along a side of a block.
BLOCK = 256


def stacked_coverage(edges: np.ndarray, block: np.ndarray, heights: np.ndarray, width: int) -> np.ndarray:
    """Share of every cell inside closed rings, for many blocks at once, one above the other.

    `edges` are (x0, y0, x1, y1) in cells of the block that `block` names; a block has as many rows as `heights` says
    and at most `width` columns. Shells and holes must run in opposite directions; the sign of a whole does not matter.
    """
    base = np.concatenate(([0], np.cumsum(heights)))
    out = np.zeros((int(base[-1]), width + 1))
    tall = heights[block]
    keep = (edges[:, 1] != edges[:, 3]) & (np.maximum(edges[:, 1], edges[:, 3]) > 0) & (np.minimum(edges[:, 1], edges[:, 3]) < tall)
    keep &= np.minimum(edges[:, 0], edges[:, 2]) < width
    x0, y0, x1, y1 = edges[keep].T
    block, tall = block[keep], tall[keep]
    if not len(x0):
        return out[:, :width]
    # Cut the edges at their block's top and bottom.
    slope = (x1 - x0) / (y1 - y0)
    c0, c1 = np.clip(y0, 0, tall), np.clip(y1, 0, tall)
    x0, x1, y0, y1 = x0 + (c0 - y0) * slope, x0 + (c1 - y0) * slope, c0, c1

    def lines(a: np.ndarray, b: np.ndarray, high: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Edge and parameter of every crossing with a grid line."""
        lo, hi = np.maximum(np.ceil(np.minimum(a, b)), 0), np.minimum(np.floor(np.maximum(a, b)), high)
        n = np.maximum(0, hi - lo + 1).astype(np.int64)
        n[a == b] = 0
        who = np.repeat(np.arange(len(a)), n)
        step = np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
        return who, (lo[who] + step - a[who]) / (b - a)[who]

    wy, ty = lines(y0, y1, tall)
    wx, tx = lines(x0, x1, width)
    n = len(x0)
    who = np.concatenate((np.arange(n), np.arange(n), wy, wx))
    t = np.clip(np.concatenate((np.zeros(n), np.ones(n), ty, tx)), 0, 1)
    order = np.lexsort((t, who))
    who, t = who[order], t[order]
    same = who[1:] == who[:-1]
    k, ta, tb = who[:-1][same], t[:-1][same], t[1:][same]
    dy = (y1 - y0)[k] * (tb - ta)
    tm = (ta + tb) / 2
    xm, ym = x0[k] + (x1 - x0)[k] * tm, y0[k] + (y1 - y0)[k] * tm
    row = np.clip(np.floor(ym).astype(np.int64), 0, tall[k] - 1) + base[block[k]]
    col = np.clip(np.floor(xm), 0, width).astype(np.int64)
    share = np.clip(col + 1 - xm, 0, 1)  # of the cell to the right of the piece
    flat = np.concatenate((row * (width + 1) + col, (row * (width + 1) + col + 1)[col < width]))
    gain = np.concatenate((dy * share, (dy * (1 - share))[col < width]))
    out = np.bincount(flat, weights=gain, minlength=out.size).reshape(out.shape)
    np.cumsum(out, axis=1, out=out)
    return np.abs(out[:, :width])


def block_coverage(edges: np.ndarray, height: int, width: int) -> np.ndarray:
    """Share of every cell of one block that lies inside closed rings."""
    return stacked_coverage(edges, np.zeros(len(edges), np.int64), np.array([height]), width)


def ring_edges(rings: geo.Rings) -> np.ndarray:
    """Edges of all rings with shells one way round and holes the other."""
    out = []
    for p in rings:
        for k, r in enumerate(p):
            r = r if (geo.signed_area(r) > 0) == (k == 0) else r[::-1]
            out.append(np.hstack((r[:-1], r[1:])))
    return np.vstack(out)


def polygon_blocks(polygons: DataFrame, grids: DataFrame, key: str = "polygon_id", geometry: str = "geometry") -> DataFrame:
    """(key, geometry, area, tile, brow, bcol, grid columns): usable polygons at every raster block that their box touches.

    `grids`: tile, tile_lat, tile_lon, x0, y0 (north-west corner), dx, dy, width, height; one row per published tile.
    """
    shapes = polygons.select(F.col(key).alias("pid"), F.col(geometry).alias("g")).where("pid is not null and g is not null")
    m = geo.measures(shapes.dropDuplicates(["pid"]), "pid", "g").where("usable").select("pid", "area", "west", "south", "east", "north")
    boxed = shapes.dropDuplicates(["pid"]).join(m, "pid")
    tiles = boxed.withColumn("t", F.explode(tiles_for_bbox(F.col("west"), F.col("south"), F.col("east"), F.col("north")))).withColumns({"tile_lat": F.col("t.lat"), "tile_lon": F.col("t.lon")}).drop("t")
    on = tiles.join(grids, ["tile_lat", "tile_lon"])
    block = lambda v, most: F.greatest(F.lit(0), F.least(F.floor(v / BLOCK), F.floor((most - 1) / BLOCK)))
    inside = (F.col("west") < F.col("x0") + F.col("dx") * F.col("width")) & (F.col("east") > F.col("x0")) & (F.col("north") > F.col("y0") - F.col("dy") * F.col("height")) & (F.col("south") < F.col("y0"))
    rows = F.sequence(block((F.col("y0") - F.col("north")) / F.col("dy"), F.col("height")), block((F.col("y0") - F.col("south")) / F.col("dy"), F.col("height")))
    cols = F.sequence(block((F.col("west") - F.col("x0")) / F.col("dx"), F.col("width")), block((F.col("east") - F.col("x0")) / F.col("dx"), F.col("width")))
    return on.where(inside).withColumn("brow", F.explode(rows)).withColumn("bcol", F.explode(cols)).select("pid", "g", "area", "tile", "x0", "y0", "dx", "dy", F.col("brow").cast("int").alias("brow"), F.col("bcol").cast("int").alias("bcol"))


#: Cells that one call of the kernel takes.
CELLS_AT_ONCE = 1 << 21


def _equal_rows(lat: np.ndarray, y0: np.ndarray, dy: np.ndarray) -> np.ndarray:
    """Raster rows of latitudes, with the part of a row told by area instead of latitude."""
    from .equalarea import q_of

    row = np.floor((y0 - lat) / dy)
    top, bottom = q_of(np.clip(y0 - row * dy, -90, 90)), q_of(np.clip(y0 - (row + 1) * dy, -90, 90))
    return row + (top - q_of(lat)) / np.where(top > bottom, top - bottom, 1)


def _cut_rows(e: np.ndarray, y0: float, dy: float) -> np.ndarray:
    """Edges cut where their chords in the equal-area plane cross the lines between raster rows; in a row the scale is one."""
    from .equalarea import q_of

    a, b = (y0 - e[:, 1]) / dy, (y0 - e[:, 3]) / dy
    first, last = np.ceil(np.minimum(a, b)), np.floor(np.maximum(a, b))
    n = np.where(a == b, 0, np.maximum(0, last - first + 1)).astype(np.int64)
    who = np.repeat(np.arange(len(e)), n)
    lat = y0 - (first[who] + np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)) * dy
    q0, q1 = q_of(e[:, 1]), q_of(e[:, 3])
    t = np.clip((q_of(lat) - q0[who]) / (q1 - q0)[who], 0, 1)
    every = np.arange(len(e))
    owner, at, lats = np.concatenate((every, who, every)), np.concatenate((np.zeros(len(e)), t, np.ones(len(e)))), np.concatenate((e[:, 1], lat, e[:, 3]))
    order = np.lexsort((at, owner))
    owner, at, lats = owner[order], at[order], lats[order]
    x = e[owner, 0] + (e[owner, 2] - e[owner, 0]) * at
    same = owner[1:] == owner[:-1]
    return np.stack((x[:-1][same], lats[:-1][same], x[1:][same], lats[1:][same]), 1)


def _cover(by_row: bool, step: float | None = None):
    """Rows (pid, area, tile, code, row, cells, y0, dx, dy): cells of each class, by raster row or by block; exact at the outline.

    With `step` the edges are chords of at most that many degrees in the equal-area plane, and parts of cells are parts of their area.
    """

    def edges_of(text: str) -> np.ndarray:
        e = ring_edges(geo.from_geojson(text))
        if step is None:
            return e
        from .equalarea import densify

        return densify(e, step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, np.ndarray] = {}
        for b in batches:
            g = b.column("g").to_pylist()
            for x in set(g) - known.keys():
                if len(known) > 5000:
                    known.clear()
                known[x] = edges_of(x)
            num = {c: b.column(c).to_numpy(zero_copy_only=False) for c in ("x0", "y0", "dx", "dy", "brow", "bcol", "height", "width")}
            facts = b.select(["pid", "area", "tile", "y0", "dx", "dy"])
            size = num["height"].astype(np.int64) * int(num["width"].max(initial=1))
            group = np.cumsum(size) // CELLS_AT_ONCE
            for k in np.unique(group):
                at = np.flatnonzero(group == k)
                for x in {g[i] for i in at} - known.keys():  # dropped above
                    known[x] = edges_of(x)
                # of a polygon's edges a block needs those of its rows that are not right of it
                parts = []
                for i in at:
                    e = known[g[i]]
                    top = num["y0"][i] - num["brow"][i] * BLOCK * num["dy"][i]
                    near = (np.minimum(e[:, 1], e[:, 3]) < top) & (np.maximum(e[:, 1], e[:, 3]) > top - num["height"][i] * num["dy"][i])
                    near &= np.minimum(e[:, 0], e[:, 2]) < num["x0"][i] + (num["bcol"][i] * BLOCK + num["width"][i]) * num["dx"][i]
                    parts.append(e[near] if step is None else _cut_rows(e[near], num["y0"][i], num["dy"][i]))
                block = np.repeat(np.arange(len(at)), [len(p) for p in parts])
                of = at[block]
                e = np.concatenate(parts)
                local = np.empty_like(e)
                local[:, 0::2] = (e[:, 0::2] - num["x0"][of][:, None]) / num["dx"][of][:, None] - (num["bcol"][of] * BLOCK)[:, None]
                down = (num["y0"][of][:, None] - e[:, 1::2]) / num["dy"][of][:, None] if step is None else _equal_rows(e[:, 1::2], num["y0"][of][:, None], num["dy"][of][:, None])
                local[:, 1::2] = down - (num["brow"][of] * BLOCK)[:, None]
                h, w = num["height"][at].astype(np.int64), num["width"][at].astype(np.int64)
                wide = int(w.max())
                cover = stacked_coverage(local, block, h, wide)
                codes = np.zeros(cover.shape, np.uint8)
                first = np.concatenate(([0], np.cumsum(h)))
                for j, i in enumerate(at):
                    codes[first[j] : first[j + 1], : w[j]] = np.frombuffer(b.column("codes")[int(i)].as_buffer(), np.uint8).reshape(h[j], w[j])
                    if w[j] < wide:
                        cover[first[j] : first[j + 1], w[j] :] = 0
                owner = np.arange(len(cover)) if by_row else np.repeat(np.arange(len(at)), h)
                key = (owner * 256)[:, None] + codes
                sums = np.bincount(key.ravel(), weights=cover.ravel())
                got = np.flatnonzero(sums > 1e-12)
                who = got // 256
                of_block = np.searchsorted(first, who, side="right") - 1 if by_row else who
                row = num["brow"][at][of_block] * BLOCK + (who - first[of_block] if by_row else 0)
                took = facts.take(pa.array(at[of_block], pa.int64()))
                yield pa.record_batch(
                    [took.column("pid"), took.column("area"), took.column("tile"), pa.array(got % 256, pa.int32()), pa.array(row, pa.int32()), pa.array(sums[got], pa.float64()), took.column("y0"), took.column("dx"), took.column("dy")],
                    ["pid", "area", "tile", "code", "row", "cells", "y0", "dx", "dy"],
                )

    return run


def covered_rows(blocks: DataFrame, raster: DataFrame, by_row: bool = True, step: float | None = None) -> DataFrame:
    """(pid, area, tile, code, row, cells, y0, dx, dy): `raster` has tile, brow, bcol, height, width, codes (bytes by row).

    Without `by_row` the cells of a block come as one number per class and `row` is the block's first row.
    """
    rows = blocks.join(raster, ["tile", "brow", "bcol"])
    kind = blocks.schema["pid"].dataType.simpleString()
    return rows.select("pid", "g", "area", "tile", "x0", "y0", "dx", "dy", "brow", "bcol", "height", "width", "codes").mapInArrow(
        _cover(by_row, step), f"pid {kind}, area double, tile string, code int, row int, cells double, y0 double, dx double, dy double"
    )


def zonal_coverage(polygons: DataFrame, grids: DataFrame, raster: DataFrame, key: str = "polygon_id", geometry: str = "geometry", nodata: int = 0) -> DataFrame:
    """(key, code, share): the share of each polygon that a class covers, in the raster's own plane; only shares above 0."""
    rows = covered_rows(polygon_blocks(polygons, grids, key, geometry), raster, by_row=False).where(F.col("code") != nodata)
    by = rows.groupBy("pid", "code").agg(F.sum(F.col("cells") * F.col("dx") * F.col("dy") / F.col("area")).alias("share"))
    return by.where("share > 0").select(F.col("pid").alias(key), "code", "share")


def equal_area_coverage(polygons: DataFrame, grids: DataFrame, raster: DataFrame, key: str = "polygon_id", geometry: str = "geometry", nodata: int = 0) -> DataFrame:
    """(key, code, area_m2, tiles): square metres per class on the ellipsoid and the tiles that gave them, at the first step."""
    from .equalarea import measure

    return measure(polygons, grids, raster, key, geometry, nodata=nodata)


def blocks_of(codes: np.ndarray) -> list[tuple[int, int, int, int, bytes]]:
    """(brow, bcol, height, width, bytes) of a raster band."""
    out = []
    for i in range(0, codes.shape[0], BLOCK):
        for j in range(0, codes.shape[1], BLOCK):
            part = np.ascontiguousarray(codes[i : i + BLOCK, j : j + BLOCK], np.uint8)
            out.append((i // BLOCK, j // BLOCK, *part.shape, part.tobytes()))
    return out


RASTER = "tile string, brow int, bcol int, height int, width int, codes binary"
GRID = "tile string, tile_lat int, tile_lon int, x0 double, y0 double, dx double, dy double, width int, height int"


def box_geojson(west: float, south: float, east: float, north: float) -> str:
    return json.dumps({"type": "Polygon", "coordinates": [[[west, south], [east, south], [east, north], [west, north], [west, south]]]})
