import json
import random
import struct

import numpy as np
import pytest

from cartolex.functions import geometry as geo
from cartolex.operators import equalarea, zonal
from cartolex.sources import rasters


def poly(*rings):
    return json.dumps({"type": "Polygon", "coordinates": [list(map(list, r)) for r in rings]})


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]


@pytest.mark.parametrize("text,ok", [
    (poly(SQUARE), True), (poly(SQUARE, HOLE), True), (poly([(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)]), False), (poly(SQUARE[:-1]), False), (None, False), ("", False), ("{", False),
    ('{"type":"Point","coordinates":[0,0]}', False), (poly(SQUARE, [(3, 3), (5, 3), (5, 5), (3, 5), (3, 3)]), False), (poly([(0, 0), (1, 0), (0, 0), (0, 0)]), False), ('{"type":"Polygon","coordinates":[]}', False),
])
def test_usable(text, ok):
    assert geo.is_usable(geo.from_geojson(text)) is ok


def test_both_ways_to_tell_simple_rings_agree():
    rng = random.Random(8)
    seen = set()
    for _ in range(600):
        n = rng.randint(3, 9)
        pts = [(rng.randint(0, 5), rng.randint(0, 5)) for _ in range(n)]
        if len(set(pts)) < 3 or any(a == b for a, b in zip(pts, [*pts[1:], pts[0]])):
            continue
        ring = [*pts, pts[0]]
        one, two = geo._few_simple(ring), geo._many_simple(np.array(ring, float))
        assert one == two, ring
        seen.add(one)
    assert seen == {True, False}


def test_long_outlines_are_swept():
    """Many thousand points take no square of them; one crossing anywhere is found."""
    a = np.linspace(0, 2 * np.pi, 40_001)
    ring = np.stack((np.cos(a) * (1 + 0.01 * np.cos(900 * a)), np.sin(a) * (1 + 0.01 * np.cos(900 * a))), 1)
    ring[-1] = ring[0]
    assert geo.is_usable([[ring]])
    bent = ring.copy()
    bent[20_000] = (0.9, 0.9)
    assert not geo.is_usable([[bent]])


def test_parts_must_not_overlap():
    far = [(x + 10, y) for x, y in SQUARE]
    near = [(x + 2, y) for x, y in SQUARE]
    multi = lambda b: json.dumps({"type": "MultiPolygon", "coordinates": [[SQUARE], [b]]})
    assert geo.is_usable(geo.from_geojson(multi(far))) and not geo.is_usable(geo.from_geojson(multi(near)))


def test_validity_agrees_with_an_independent_library(spark):
    reader = spark._jvm.org.locationtech.jts.io.WKTReader()
    rng = random.Random(4)
    for _ in range(150):
        n = rng.randint(4, 9)
        ring = [(rng.randint(0, 9), rng.randint(0, 9)) for _ in range(n)]
        ring.append(ring[0])
        g = reader.read("POLYGON((" + ",".join(f"{x} {y}" for x, y in ring) + "))")
        assert geo.is_usable(geo.from_geojson(poly(ring))) == bool(g.isValid() and g.getArea() > 0), ring


def test_wkb_and_centroid():
    ring = np.array(SQUARE, float)
    data = struct.pack("<BII", 1, 3, 1) + struct.pack("<I", 5) + ring.tobytes()
    rings = geo.from_wkb(data)
    assert geo.centroid(rings) == (2, 2) and geo.area(rings) == 16 and geo.bounds(rings) == (0, 0, 4, 4)
    assert geo.from_wkb(b"") is None and geo.from_wkb(data[:20]) is None
    with_hole = [[ring, np.array(HOLE, float)]]
    assert geo.area(with_hole) == 15


def test_cell_areas_agree_with_an_independent_library(spark):
    jts = spark._jvm.org.locationtech.jts
    reader = jts.io.WKTReader()
    rng = np.random.default_rng(3)
    for _ in range(12):
        angles = np.sort(rng.uniform(0, 2 * np.pi, 9))
        r = rng.uniform(1.5, 7, 9)
        ring = np.column_stack((5 + r * np.cos(angles), 4 + r * np.sin(angles)))
        ring = np.vstack((ring, ring[:1]))
        if not geo.is_usable([[ring]]):
            continue
        got = zonal.block_coverage(zonal.ring_edges([[ring]]), 8, 10)
        g = reader.read("POLYGON((" + ",".join(f"{x!r} {y!r}" for x, y in ring.tolist()) + "))")
        for i in range(8):
            for j in range(10):
                cell = reader.read(f"POLYGON(({j} {i},{j + 1} {i},{j + 1} {i + 1},{j} {i + 1},{j} {i}))")
                assert got[i, j] == pytest.approx(g.intersection(cell).getArea(), abs=1e-9)


def world(spark, codes, tile="N00E000", y0=4.0):
    h, w = codes.shape
    grids = spark.createDataFrame([(tile, 0, 0, 0.0, y0, 1.0, 1.0, w, h), (tile + "x", 0, 3, 3.0, y0, 1.0, 1.0, 0, 0)], zonal.GRID).where("width > 0")
    return grids, spark.createDataFrame([(tile, *b) for b in zonal.blocks_of(codes)], zonal.RASTER)


HALVES = np.array([[10, 10, 50, 50]] * 4, np.uint8)


@pytest.mark.parametrize("box,want", [((0, 0, 4, 4), {10: 0.5, 50: 0.5}), ((0, 0, 2, 4), {10: 1}), ((0.5, 0, 2.5, 4), {10: 0.75, 50: 0.25}), ((2, 0, 6, 4), {50: 0.5})])
def test_planar_shares(spark, box, want):
    df = spark.createDataFrame([("p", zonal.box_geojson(*box)), ("p", zonal.box_geojson(*box)), (None, "x"), ("bad", "{")], "polygon_id string, geometry string")
    got = {r["code"]: r["share"] for r in zonal.zonal_coverage(df, *world(spark, HALVES)).collect()}
    assert got == pytest.approx(want)


def test_nodata_and_holes(spark):
    codes = np.array([[10] * 4] * 2 + [[0] * 4] * 2, np.uint8)
    df = spark.createDataFrame([("p", poly(SQUARE)), ("h", poly(SQUARE, [(0, 2), (4, 2), (4, 3), (0, 3), (0, 2)]))], "polygon_id string, geometry string")
    got = {(r["polygon_id"], r["code"]): r["share"] for r in zonal.zonal_coverage(df, *world(spark, codes)).collect()}
    assert got[("p", 10)] == pytest.approx(0.5) and got.get(("h", 10), 1 / 3) == pytest.approx(1 / 3)


def test_equal_area_matches_the_closed_form(spark):
    from pyspark.sql import functions as F

    from cartolex.functions.projection import box_area_m2

    df = spark.createDataFrame([("p", zonal.box_geojson(0, 0, 4, 4))], "polygon_id string, geometry string")
    rows = zonal.equal_area_coverage(df, *world(spark, HALVES)).collect()
    whole = spark.range(1).select(box_area_m2(*[F.lit(float(x)) for x in (0, 0, 4, 4)])).first()[0]
    assert sum(r["area_m2"] for r in rows) == pytest.approx(whole, rel=1e-12) and all(r["tiles"] == ["N00E000"] for r in rows)


def test_attempts_keep_every_row(spark):
    """One record per raw row, in order, with the first reason that holds."""
    box = zonal.box_geojson(0, 0, 1, 1)
    rows = [("a", box), (None, box), ("  ", box), ("bad", "{"), ("none", None), ("far", zonal.box_geojson(50, 50, 51, 51)), ("a", box), ("wide", zonal.box_geojson(-90, 0, 90.5, 1)), ("pole", zonal.box_geojson(0, 80, 1, 90)), ("out", zonal.box_geojson(179, 0, 181, 1)), ("two", zonal.box_geojson(0, 0, 2.45, 2))]
    df = spark.createDataFrame(rows, "polygon_id string, geometry string").coalesce(1)
    got = equalarea.attempts(df, *world(spark, HALVES)).orderBy("ordinal").collect()
    assert [r["ordinal"] for r in got] == list(range(len(rows))) and [r["source_polygon_id"] for r in got] == ["a", "row:1", "row:2", "bad", "none", "far", "a", "wide", "pole", "out", "two"]
    rejected = "area_measurement_rejected:"
    assert [r["error"] for r in got] == [
        None, "source_polygon_id_missing", "source_polygon_id_missing", "geometry_unusable", "geometry_unusable", None, None, rejected + equalarea.WRAP, rejected + equalarea.EDGE, rejected + equalarea.EDGE, None,
    ]
    assert got[0]["class_areas"][0]["code"] == 10 and got[0]["attempted"] == ["N00E000"] and got[5]["missing"] == got[5]["attempted"] == ["N48E048", "N51E048", "N48E051", "N51E051"][:1]
    assert got[5]["polygon_area_m2"] > 0 and got[5]["class_areas"] is None and [x["ids"] for x in got[10]["evidence"]] == [["N00E000"], ["N00E000"]]
    broken = spark.createDataFrame([("N00E000", "OSError")], "tile string, error string")
    errors = {r["source_polygon_id"]: r["error"] for r in equalarea.attempts(df.where("polygon_id in ('a', 'far')"), *world(spark, HALVES), broken=broken).collect()}
    assert errors == {"a": "tile_read_failed:OSError", "far": None}
    assert equalarea.attempts(df.limit(0), *world(spark, HALVES)).count() == 0


def slanted(n=60, size=1.7):
    """A circle, most of whose edges are neither meridians nor parallels, at a high latitude."""
    a = np.linspace(0, 2 * np.pi, n + 1)
    ring = np.stack((1.8 + size * np.cos(a), 61.8 + size * np.sin(a)), 1)
    ring[-1] = ring[0]
    return ring


def test_chords_are_within_their_bound():
    """The area of chords at each step differs from that of very fine ones by no more than the bound of either."""
    edges = zonal.ring_edges([[slanted()]])
    fine = equalarea.chord_area(equalarea.densify(edges, 1e-4))
    for step in (1.0, 0.1, 0.01, 0.001):
        cut = equalarea.densify(edges, step)
        assert np.hypot(cut[:, 2] - cut[:, 0], cut[:, 3] - cut[:, 1]).max() <= step * (1 + 1e-12)
        bound = equalarea.chord_bound(edges, step)
        assert 0 < bound and abs(equalarea.chord_area(cut) - fine) <= bound + 1e-6 * fine * step**2 + 1e-3
    assert equalarea.chord_bound(zonal.ring_edges([[np.array(SQUARE, float)]]), 0.01) == 0.0
    with pytest.raises(ValueError):
        equalarea.densify(edges, 1e-9)


def test_classes_add_up_to_the_polygon(spark):
    """Cells that cover a whole polygon give its own area, also where edges cross rows of different scale."""
    codes = np.full((16, 16), 10, np.uint8)
    codes[:, 7:] = 50
    grids = spark.createDataFrame([("N60E000", 60, 0, 0.0, 64.0, 0.25, 0.25, 16, 16)], zonal.GRID)
    raster = spark.createDataFrame([("N60E000", *b) for b in zonal.blocks_of(codes)], zonal.RASTER)
    df = spark.createDataFrame([("p", poly(slanted(24, 1.1).tolist()))], "polygon_id string, geometry string")
    for step in (0.3, 0.01):
        got = equalarea.measure(df, grids, raster, step=step).collect()
        whole = equalarea.facts(df, step=step).first()
        assert whole["reason"] is None and sum(r["area_m2"] for r in got) == pytest.approx(whole["whole"], rel=1e-9)


def test_the_ladder_refines_and_fails_closed(spark):
    """A class near the threshold is measured at finer steps; one that stays undecided at the last is refused."""
    a = np.linspace(0, 2 * np.pi, 41)
    ring = np.stack((1.5 + 1.2 * np.cos(a), 61.5 + 1.2 * np.sin(a)), 1)
    ring[-1] = ring[0]
    edges = zonal.ring_edges([[ring]])
    whole = equalarea.chord_area(equalarea.densify(edges, 0.0001))
    df = spark.createDataFrame([("p", poly(ring.tolist())), ("far", zonal.box_geojson(0, 0, 1, 1)), (None, poly(ring.tolist()))], "polygon_id string, geometry string")
    codes = np.zeros((12, 12), np.uint8)
    codes[:, :7] = 10
    grids = spark.createDataFrame([("N60E000", 60, 0, 0.0, 63.0, 0.25, 0.25, 12, 12)], zonal.GRID)
    raster = spark.createDataFrame([("N60E000", *b) for b in zonal.blocks_of(codes)], zonal.RASTER)
    share = equalarea.measure(df, grids, raster, step=0.0001).where("polygon_id = 'p' and code = 10").first()["area_m2"] / whole
    for near, step, ok in ((share + 0.2, 0.01, True), (share, 0.0001, False)):
        records, areas = equalarea.refined(df, grids, raster, threshold=near)
        r = {x["polygon_id"]: x for x in records.collect()}
        assert sorted(r) == ["far", "p"] and r["far"]["reason"] is None and r["p"]["step"] == step
        assert (r["p"]["reason"] is None) == ok and areas.where("polygon_id = 'p'").count() == int(ok)
        if not ok:
            assert r["p"]["reason"].startswith("area_measurement_rejected:coverage_accuracy_bound_unresolved_at_") and "class=10;step=0.0001" in r["p"]["reason"]
    between = share + 3 * equalarea.chord_bound(edges, 0.001) / whole
    records, _ = equalarea.refined(df, grids, raster, threshold=between)
    assert records.where("polygon_id = 'p'").first()["step"] == 0.001 and records.where("reason is not null").count() == 0


@pytest.mark.parametrize("rings,reason", [
    ([[np.array(SQUARE, float)]], None), (None, equalarea.INVALID), ([[np.array([(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)], float)]], equalarea.INVALID),
    ([[np.array([(-100, 0), (100, 0), (100, 1), (-100, 1), (-100, 0)], float)]], equalarea.WRAP), ([[np.array([(0, -90), (1, -90), (1, 0), (0, -90)], float)]], equalarea.EDGE),
    ([[np.array([(-100, 0), (0, 0), (90, 0), (90, 1), (0, 1), (-100, 1), (-100, 0)], float)]], equalarea.ANTIMERIDIAN),
])
def test_guards(rings, reason):
    assert equalarea.guard(rings) == reason


def test_windows_predictors_and_planes():
    """Windows unpack what they meet; differences and LZW are read; other planes and directions are refused."""
    codes = np.random.default_rng(2).integers(0, 5, (40, 30)).astype(np.uint8)
    data = rasters.encode(codes, 1.0, 4.0, 0.1, 0.1)
    band, place = rasters.decode(data, (5, 7, 10, 12))
    assert (band == codes[5:15, 7:19]).all() and place == pytest.approx((1.7, 3.5, 0.1, 0.1))
    assert rasters.decode(data, (38, 28, 10, 10))[0].shape == (2, 2)
    assert rasters.layout(rasters.tags_of(data))[:2] == (30, 40)
    tags = rasters.tags_of(data)
    for change in ({rasters.GEOKEYS: (1, 1, 0, 1, rasters.GEOGRAPHIC_TYPE, 0, 1, 3857)}, {rasters.GEOKEYS: (1, 1, 0, 1, rasters.MODEL_TYPE, 0, 1, 1)}, {33550: (0.1, -0.1, 0.0)}, {258: (16,)}):
        with pytest.raises(ValueError):
            rasters.layout({**tags, **change})
    assert rasters.layout({**tags, rasters.GEOKEYS: (1, 1, 0, 2, rasters.MODEL_TYPE, 0, 1, 2, rasters.GEOGRAPHIC_TYPE, 0, 1, 4326)})
    # codes of nine bits: clear, a, b, then the pair that they made, and the end
    bits = "".join(f"{x:09b}" for x in (256, 97, 98, 258, 257))
    assert rasters._lzw(int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")) == b"abab"


@pytest.mark.parametrize("deflate", [True, False])
def test_tiles_from_files(spark, tmp_path, deflate):
    codes = np.random.default_rng(1).integers(0, 11, (300, 290)).astype(np.uint8)
    (tmp_path / "N03W006.tif").write_bytes(rasters.encode(codes, -6.0, 6.0, 0.01, 0.01, deflate))
    band, place = rasters.decode((tmp_path / "N03W006.tif").read_bytes())
    assert (band == codes).all() and place == (-6.0, 6.0, 0.01, 0.01)
    grids, raster = rasters.read_tiles(spark, str(tmp_path))
    g = grids.first()
    assert (g["tile"], g["tile_lat"], g["tile_lon"], g["width"], g["height"]) == ("N03W006", 3, -6, 290, 300)
    assert sum(r["height"] * r["width"] for r in raster.collect()) == codes.size
    with pytest.raises(ValueError):
        rasters.decode(b"nonsense")
