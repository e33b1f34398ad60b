"""Class areas in square metres on the ellipsoid, with a bound of their error, finer steps where it matters, and guards.

Edges of polygons are straight in longitude and latitude. In the cylindrical equal-area plane they are curves; cut into
pieces of at most a step, each piece is taken as a chord there, and the area between curve and chord is bounded. Coverage of
cells and area of the polygon are both those of the chord polygon, so they go together exactly. A polygon of which
some class may lie on either side of the dominance threshold is measured again at a finer step; one that stays undecided at
the finest is refused rather than guessed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions.grid import tile_name, tiles_for_bbox
from ..functions.projection import ECCENTRICITY, ECCENTRICITY_2, SEMI_MAJOR
from ..functions.runtime import materialise
from ..schema import CLASSES, THRESHOLD
from . import zonal

#: Steps in degrees, from the first to the finest; coordinates of a cut polygon at most.
STEPS, POINTS_MOST = (0.01, 0.001, 0.0001), 1_000_000
# Limits of the domain and the reasons that are recorded.
POLE, SPAN = 89.999999, 180.0
INVALID, EDGE, ANTIMERIDIAN, WRAP = (
    "worldcover_polygon_invalid_or_unsupported_type", "worldcover_pole_or_crs_edge_unsupported", "worldcover_antimeridian_span_unsupported", "worldcover_longitude_wrapping_unsupported",
)
#: By how much class areas may exceed the polygon's for the rounding of sums.
SUPPORT = 1e-8


def q_of(lat: np.ndarray) -> np.ndarray:
    """The authalic function of latitudes in degrees."""
    s = np.sin(np.radians(lat))
    es = ECCENTRICITY * s
    return (1 - ECCENTRICITY_2) * (s / (1 - es * es) + np.arctanh(es) / ECCENTRICITY)


def guard(rings: geo.Rings | None) -> str | None:
    """Why a polygon is out of the domain, or None: not usable, wrapping, beyond the frame, at a pole, half the globe wide."""
    if not rings or not geo.is_usable(rings):
        return INVALID
    if any(np.abs(np.diff(r[:, 0])).max(initial=0) > SPAN for p in rings for r in p):
        return WRAP
    for p in rings:
        (west, south), (east, north) = p[0].min(0), p[0].max(0)
        if west < -180 or east > 180 or south <= -POLE or north >= POLE:
            return EDGE
        if east - west >= SPAN:
            return ANTIMERIDIAN
    return None


def pieces(edges: np.ndarray, step: float) -> np.ndarray:
    """Into how many equal pieces each edge (x0, y0, x1, y1) is cut so that none is longer than the step."""
    return np.maximum(1, np.ceil(np.hypot(edges[:, 2] - edges[:, 0], edges[:, 3] - edges[:, 1]) / step)).astype(np.int64)


def densify(edges: np.ndarray, step: float) -> np.ndarray:
    """Edges cut into pieces of at most the step; ValueError beyond POINTS_MOST."""
    n = pieces(edges, step)
    if int(n.sum()) > POINTS_MOST:
        raise ValueError("too many coordinates")
    k = np.repeat(np.arange(len(edges)), n)
    i = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
    d = (edges[k, 2:] - edges[k, :2]) / n[k, None]
    a, b = edges[k, :2] + d * i[:, None], edges[k, :2] + d * (i + 1)[:, None]
    last = i + 1 == n[k]
    b[last] = edges[k[last], 2:]
    return np.hstack((a, b))


def chord_bound(edges: np.ndarray, step: float) -> float:
    """Square metres between the edges and their chords in the equal-area plane, at most.

    Along a piece, latitude is linear; a function with second derivative up to M leaves its chord by M t (1 - t) h^2 / 2,
    whose integral is M h^2 / 12 per unit of length, and the plane's height is half the authalic function, of which
    2 / (1 - e^2) bounds the second derivative. All roundings go up.
    """
    wide, high = np.radians(np.abs(edges[:, 2] - edges[:, 0])), np.radians(edges[:, 3] - edges[:, 1])
    curved = (wide > 0) & (high != 0)
    if not curved.any():
        return 0.0
    most = math.nextafter(2 / (1 - ECCENTRICITY_2), math.inf)
    factor = math.nextafter(SEMI_MAJOR**2 * most / 24, math.inf)
    one = np.nextafter(factor * wide[curved] * high[curved] ** 2 / pieces(edges[curved], step).astype(float) ** 2 * (1 + 2.0**-47), np.inf)
    return math.nextafter(math.fsum(one), math.inf)


def chord_area(edges: np.ndarray) -> float:
    """Square metres inside closed rings of edges that are chords in the equal-area plane."""
    x0, x1, y0, y1 = np.radians(edges[:, 0]), np.radians(edges[:, 2]), q_of(edges[:, 1]), q_of(edges[:, 3])
    return abs(math.fsum((x1 - x0) * (y0 + y1))) * SEMI_MAJOR**2 / 4


def _facts(step: float):
    """(k, reason, whole, bound): guard, area and error bound of each polygon at a step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reasons, wholes, bounds = [], [], []
            for g in b.column("g").to_pylist():
                rings = geo.from_geojson(g) if g else None
                reason, whole, bound = guard(rings), None, None
                if reason is None:
                    edges = zonal.ring_edges(rings)
                    try:
                        whole, bound = chord_area(densify(edges, step)), chord_bound(edges, step)
                    except ValueError:
                        reason = "worldcover_densification_limit"
                reasons.append(reason)
                wholes.append(whole)
                bounds.append(bound)
            yield pa.record_batch({"k": b.column("k"), "reason": pa.array(reasons, pa.string()), "whole": pa.array(wholes, pa.float64()), "bound": pa.array(bounds, pa.float64())})

    return run


def facts(polygons: DataFrame, key: str = "polygon_id", geometry: str = "geometry", step: float = STEPS[0]) -> DataFrame:
    """(key, reason, whole, bound): why a polygon is refused, else its area in square metres and the bound of its error at a step."""
    rows = polygons.select(F.col(key).alias("k"), F.col(geometry).alias("g"))
    return rows.mapInArrow(_facts(step), f"k {rows.schema['k'].dataType.simpleString()}, reason string, whole double, bound double").withColumnRenamed("k", key)


def measure(polygons: DataFrame, grids: DataFrame, raster: DataFrame, key: str = "polygon_id", geometry: str = "geometry", step: float = STEPS[0], nodata: int = 0) -> DataFrame:
    """(key, code, area_m2, tiles): class areas of the chord polygons at a step, and the tiles that gave them."""
    rows = zonal.covered_rows(zonal.polygon_blocks(polygons, grids, key, geometry), raster, step=step).where(F.col("code") != nodata)
    north = F.col("y0") - F.col("row") * F.col("dy")
    cell = F.radians("dx") * (zonal.authalic_q(north) - zonal.authalic_q(north - F.col("dy"))) * (SEMI_MAJOR**2 / 2)
    by = rows.groupBy("pid", "code", "tile").agg(F.sum(F.col("cells") * cell).alias("a")).where("a > 0")
    return by.groupBy("pid", "code").agg(F.sum("a").alias("area_m2"), F.array_sort(F.collect_set("tile")).alias("tiles")).withColumnRenamed("pid", key)


def enclosure(part, whole, part_error, whole_error, threshold: float = THRESHOLD):
    """(lower, upper, crosses) of part / whole when each may be off by its error."""
    lower = F.greatest(F.lit(0.0), F.try_divide(part - part_error, whole + whole_error))
    upper = F.coalesce(F.try_divide(part + part_error, F.greatest(whole - whole_error, F.lit(0.0))), F.lit(float("inf")))
    return F.struct(lower.alias("lower"), upper.alias("upper"), ((lower < threshold) & (upper >= threshold)).alias("crosses"))


def refined(polygons: DataFrame, grids: DataFrame, raster: DataFrame, key: str = "polygon_id", geometry: str = "geometry", threshold: float = THRESHOLD, steps: tuple[float, ...] = STEPS) -> tuple[DataFrame, DataFrame]:
    """(records, areas). records: (key, reason, whole, bound, class_bound, step) of each polygon; areas: (key, code, area_m2, tiles).

    All polygons are measured at the first step. Those of which a class is not clearly on one side of the threshold go on to
    the next, every step a job over fewer polygons; those undecided at the last are refused with the class, the step and
    its bounds. A class's error is the polygon's bound once per tile it was read from. Polygons with class areas
    beyond their own area are refused as well. Rows of one key are one polygon.
    """
    rows = materialise(polygons.where(F.col(key).isNotNull()).select(key, geometry).dropDuplicates([key]))
    open_, records, areas = rows, None, None
    for number, step in enumerate(steps):
        f = materialise(facts(open_, key, geometry, step).withColumn("step", F.lit(step)))
        good = open_.join(f.where("reason is null").select(key), key, "left_semi")
        got = materialise(measure(good, grids, raster, key, geometry, step))
        of = got.groupBy(key).agg(
            F.collect_list(F.struct("code", "area_m2")).alias("parts"), F.sum("area_m2").alias("support"), F.size(F.array_distinct(F.flatten(F.collect_list("tiles")))).alias("sources"),
        )  # as many entries as there are classes
        joined = f.join(of, key, "left").withColumn("class_bound", F.col("bound") * F.coalesce("sources", F.lit(0)))
        inside = F.coalesce(F.filter("parts", lambda x: x["code"].isin(*CLASSES)), F.array().cast("array<struct<code:int,area_m2:double>>"))
        crossing = F.filter(inside, lambda x: enclosure(x["area_m2"], F.col("whole"), F.col("class_bound"), F.col("bound"), threshold)["crosses"])
        first = F.array_min(F.transform(crossing, lambda x: x["code"]))
        heavy = F.coalesce(F.col("support") > F.col("whole") * (1 + SUPPORT), F.lit(False))
        flat = ~F.coalesce(F.col("whole") > 0, F.lit(False))
        reason = F.coalesce(
            F.when(F.col("reason").isNotNull(), F.concat(F.lit("area_measurement_rejected:"), "reason")), F.when(flat | heavy, "raster_measurement_failed:ValueError"),
            F.when(first.isNotNull(), F.format_string("area_measurement_rejected:coverage_accuracy_bound_unresolved_at_%s:class=%d;step=%s", F.lit(str(threshold)), first, F.lit(f"{step:g}"))),
        )
        told = materialise(joined.select(key, reason.alias("reason"), "whole", "bound", "class_bound", "step", (first.isNotNull() & ~flat & ~heavy & F.col("reason").isNull()).alias("again")))
        last = number + 1 == len(steps)
        done = told if last else told.where("not again")
        records = done if records is None else records.unionByName(done)
        fine = got.join(done.where("reason is null").select(key), key, "left_semi")
        areas = fine if areas is None else areas.unionByName(fine)
        if last or (again := told.where("again")).isEmpty():
            break
        open_ = materialise(open_.join(again.select(key), key, "left_semi"))
    return records.drop("again"), areas


def with_ordinals(rows: DataFrame, name: str = "ordinal") -> DataFrame:
    """Rows numbered from 0 in the order they are read; written once, so a task that is run again changes no number."""
    marked = materialise(rows.withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    counts = marked.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    starts = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_s"))  # a row per task
    return marked.withColumn("_p", part).join(F.broadcast(starts), "_p").withColumn(name, F.col("_s") + F.col("_m").bitwiseAND((1 << 33) - 1)).drop("_m", "_p", "_s")


def attempts(polygons: DataFrame, grids: DataFrame, raster: DataFrame, key: str = "polygon_id", geometry: str = "geometry", broken: DataFrame | None = None) -> DataFrame:
    """Exactly one record per raw row: (ordinal, source_polygon_id, polygon_area_m2, class_areas, attempted, missing, evidence, error, step, bound).

    Reasons, the first that holds: source_polygon_id_missing (the id is then `row:<ordinal>`), geometry_unusable,
    tile_read_failed:<kinds> for tiles named in `broken` (tile, error), then what `refined` says. Tiles that are not
    published leave a part of the polygon without class, which is no error. Rows of one id and geometry share a measure.
    """
    rows = with_ordinals(polygons.select(F.col(key).cast("string").alias("raw"), F.col(geometry).alias("g")))
    rows = rows.withColumns({"id": F.nullif(F.trim("raw"), F.lit("")), "shape": F.when(F.col("g").isNotNull(), F.md5("g"))})
    shapes = materialise(rows.where("id is not null and shape is not null").groupBy("shape").agg(F.first("g").alias("g")))
    m = geo.measures(shapes, "shape", "g")
    names = F.transform(tiles_for_bbox(F.col("west"), F.col("south"), F.col("east"), F.col("north")), lambda t: tile_name(t["lat"], t["lon"]))
    m = materialise(m.select("shape", F.coalesce("usable", F.lit(False)).alias("usable"), names.alias("attempted")))
    touched = m.where("usable").select("shape", F.explode("attempted").alias("tile"))
    gone = touched.join(grids.select("tile"), "tile", "left_anti").groupBy("shape").agg(F.array_sort(F.collect_set("tile")).alias("missing"))
    measured = shapes.join(m.where("usable").select("shape"), "shape", "left_semi")
    if broken is not None:
        failed = touched.join(broken, "tile").groupBy("shape").agg(F.concat(F.lit("tile_read_failed:"), F.array_join(F.array_sort(F.collect_set("error")), ",")).alias("failed"))
        measured = measured.join(failed.select("shape"), "shape", "left_anti")
    records, areas = refined(measured, grids, raster, "shape", "g")
    by = areas.groupBy("shape").agg(
        F.array_sort(F.collect_list(F.struct("code", F.col("area_m2").alias("area")))).alias("class_areas"), F.array_sort(F.collect_list(F.struct("code", F.col("tiles").alias("ids")))).alias("evidence")
    )
    out = rows.select("ordinal", "id", "shape").join(m, "shape", "left").join(gone, "shape", "left").join(records, "shape", "left").join(by, "shape", "left")
    error = F.when(F.col("id").isNull(), "source_polygon_id_missing").when(~F.coalesce("usable", F.lit(False)), "geometry_unusable")
    if broken is not None:
        out = out.join(failed, "shape", "left")
        error = error.when(F.col("failed").isNotNull(), F.col("failed"))
    error = error.otherwise(F.col("reason"))
    seen = F.col("id").isNotNull() & F.coalesce("usable", F.lit(False))
    none = F.array().cast("array<string>")
    return out.select(
        "ordinal", F.coalesce("id", F.concat(F.lit("row:"), F.col("ordinal").cast("string"))).alias("source_polygon_id"), F.when(error.isNull(), F.col("whole")).alias("polygon_area_m2"),
        F.when(error.isNull(), F.col("class_areas")).alias("class_areas"), F.when(seen, F.col("attempted")).otherwise(none).alias("attempted"), F.when(seen, F.coalesce("missing", none)).otherwise(none).alias("missing"),
        F.when(error.isNull(), F.col("evidence")).alias("evidence"), error.alias("error"), F.when(error.isNull(), F.col("step")).alias("step"), F.when(error.isNull(), F.col("bound")).alias("bound"),
    )
