import hashlib
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartolex.functions import grid, projection, splits, text

QUICK = settings(max_examples=15, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
BLANKS = " \t\n\r\x0b\x1c\x85\xa0   　"


def one(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


@QUICK
@given(st.lists(st.text(alphabet="aé9ß語" + BLANKS, max_size=30), min_size=1, max_size=20))
def test_normalise_is_python_split(spark, texts):
    got = one(spark, [(t,) for t in texts], "t string", text.normalise(F.col("t")), text.word_count(F.col("t")))
    assert got == [(" ".join(t.split()), len(t.split())) for t in texts]


def test_text_of_null_and_empty(spark):
    got = one(spark, [(None,), ("",), ("  ",)], "t string", text.normalise(F.col("t")), text.word_count(F.col("t")), text.usable_text(F.col("t")))
    assert got == [(None, 0, None), ("", 0, None), ("", 0, None)]


def test_dedup_key_separates_text_and_label(spark):
    rows = [("a  b", 10), ("a b1", 0), ("a b", 10)]
    got = one(spark, rows, "t string, c int", text.dedup_key(F.col("t"), F.col("c")))
    want = [hashlib.sha256(" ".join(t.split()).encode() + b"\0" + str(c).encode()).hexdigest() for t, c in rows]
    assert [g[0] for g in got] == want and got[0] == got[2] != got[1]


def test_unit_hash_and_split(spark):
    cells = [f"c{i}" for i in range(300)]
    got = one(spark, [(c,) for c in cells], "c string", splits.unit_hash(F.col("c")), splits.assign_split(splits.unit_hash(F.col("c"))))
    for c, (u, s) in zip(cells, got):
        v = int.from_bytes(hashlib.sha256(f"20180101:{c}".encode()).digest()[:8], "big") / 2**64
        assert u == pytest.approx(v, abs=1e-15)
        assert s == ("train" if v < 0.8 else "validation" if v < 0.8 + 0.1 else "test")


def test_split_edges_are_left_closed(spark):
    got = one(spark, [(0.0,), (0.8,), (0.8 + 0.1,), (None,)], "u double", splits.assign_split(F.col("u")))
    assert [g[0] for g in got] == ["train", "validation", "test", None]


def test_bad_shares_are_refused():
    with pytest.raises(ValueError):
        splits.assign_split(F, (("a", 0.5), ("b", 0.6)))


def test_cell_is_a_function_of_place(spark):
    rows = [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0), (91.0, 0.0), (None, 0.0)]
    got = one(spark, rows, "lat double, lon double", splits.cell_for(F.col("lat"), F.col("lon"), 3))
    assert all(g[0] for g in got[:3]) and got[3] == got[4] == (None,)


@pytest.mark.parametrize("value,line", [(0.0, 0), (2.999, 0), (3.0, 3), (-0.1, -3), (-3.0, -3), (-5e-324, -3), (179.9, 177)])
def test_tile_floor(spark, value, line):
    assert one(spark, [(value,)], "v double", grid.tile_floor(F.col("v"))) == [(line,)]


@pytest.mark.parametrize("lat,lon,name", [(48, 6, "N48E006"), (-12, -78, "S12W078"), (0, 0, "N00E000")])
def test_tile_name(spark, lat, lon, name):
    assert one(spark, [(lat, lon)], "a int, b int", grid.tile_name(F.col("a"), F.col("b"))) == [(name,)]


def test_tiles_of_boxes(spark):
    boxes = [(0.5, 0.5, 1.0, 1.0), (0.0, 0.0, 3.0, 3.0), (3.0, 3.0, 3.0, 3.0), (2.0, 2.0, 4.0, 4.0), (4.0, 0.0, 2.0, 1.0), (None, 0.0, 1.0, 1.0)]
    got = one(spark, boxes, "w double, s double, e double, n double", grid.tiles_for_bbox(*map(F.col, "wsen")))
    assert [[tuple(t) for t in g[0]] for g in got] == [[(0, 0)], [(0, 0)], [(3, 3)], [(0, 0), (0, 3), (3, 0), (3, 3)], [], []]


def test_equal_area_box_is_the_whole_ellipsoid(spark):
    got = one(spark, [(-180.0, -90.0, 180.0, 90.0)], "w double, s double, e double, n double", projection.box_area_m2(*map(F.col, "wsen")))
    assert got[0][0] == pytest.approx(5.10065621724e14, rel=1e-9)


def test_ratio_enclosure(spark):
    got = one(spark, [(0.8, 1.0, 0.01), (0.5, 1.0, 0.01), (0.0, 0.0, 0.0)], "a double, b double, e double", projection.ratio_enclosure(F.col("a"), F.col("b"), F.col("e")))
    assert [g[0]["crosses"] for g in got][:2] == [True, False]
    assert math.isclose(got[0][0]["upper"], 0.81 / 0.99)
