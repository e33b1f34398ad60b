"""Polygon geometry in numpy: parsing, validity, area, centroid. Rings travel as multi -> polygon -> ring -> (x, y)."""

from __future__ import annotations

import json
import math
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import spread

Rings = list[list[np.ndarray]]


def from_geojson(text: str | None) -> Rings | None:
    """Rings of a Polygon or MultiPolygon; None for anything else or malformed."""
    try:
        g = json.loads(text or "null")
        kind, coords = g["type"], g["coordinates"]
        parts = {"Polygon": [coords], "MultiPolygon": coords}[kind]
        out = [[np.array(r, float)[:, :2] for r in p] for p in parts]
        return out if out and all(p and all(r.ndim == 2 and len(r) for r in p) for p in out) else None
    except (ValueError, TypeError, KeyError, IndexError, RecursionError):
        return None


def from_wkb(data: bytes | None) -> Rings | None:
    """Rings of a well-known-binary Polygon or MultiPolygon of either byte order, extra dimensions dropped."""
    if not data:
        return None

    def read(at: int) -> tuple[Rings, int]:
        order = "<" if data[at] == 1 else ">"
        (kind,) = struct.unpack_from(order + "I", data, at + 1)
        at += 5
        if kind & 0x20000000:  # an SRID follows
            at += 4
        dims = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000) + {0: 0, 1: 1, 2: 1, 3: 2}[(kind & 0xFFFFFFF) // 1000]
        base = (kind & 0xFFFFFFF) % 1000
        (n,) = struct.unpack_from(order + "I", data, at)
        at += 4
        if base == 6:
            parts: Rings = []
            for _ in range(n):
                more, at = read(at)
                parts += more
            return parts, at
        if base != 3:
            raise ValueError("no polygon")
        rings = []
        for _ in range(n):
            (m,) = struct.unpack_from(order + "I", data, at)
            at += 4
            rings.append(np.frombuffer(data, order + "f8", m * dims, at).reshape(m, dims)[:, :2].astype(float))
            at += m * dims * 8
        return [rings], at

    try:
        rings = read(0)[0]
        return rings or None
    except (struct.error, ValueError, KeyError, IndexError):
        return None


def signed_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float(np.dot(x[:-1], y[1:]) - np.dot(x[1:], y[:-1])) / 2


def area(rings: Rings) -> float:
    return sum(abs(signed_area(p[0])) - sum(abs(signed_area(h)) for h in p[1:]) for p in rings)


def centroid(rings: Rings) -> tuple[float, float] | None:
    """Area centroid; None for no area."""
    sx = sy = sa = 0.0
    for p in rings:
        for k, r in enumerate(p):
            o = r[0]
            x, y = (r - o).T
            cross = x[:-1] * y[1:] - x[1:] * y[:-1]
            a = cross.sum() / 2
            if a == 0:
                continue
            sign = (1 if k == 0 else -1) * (1 if a > 0 else -1)
            sa += sign * a
            sx += sign * (((x[:-1] + x[1:]) * cross).sum() / 6 + a * o[0])
            sy += sign * (((y[:-1] + y[1:]) * cross).sum() / 6 + a * o[1])
    return (sx / sa, sy / sa) if sa else None


def bounds(rings: Rings) -> tuple[float, float, float, float]:
    xy = np.vstack([p[0] for p in rings])
    return (*xy.min(0).tolist(), *xy.max(0).tolist())


def _orient(ax, ay, bx, by, cx, cy):
    return np.sign((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def _segments(ring: np.ndarray) -> np.ndarray:
    return np.hstack((ring[:-1], ring[1:]))


def _meetings(a: np.ndarray, b: np.ndarray, at_once: int = 1_000_000) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(i, j, proper) for pairs of segments of a and b that share a point.

    A sweep: segments of b are sorted by their lower bound along the axis that leaves fewer pairs, and each segment of a
    meets those whose bounds there reach it, at most `at_once` pairs at a time.
    """
    los, his = [np.minimum(x[:, :2], x[:, 2:]) for x in (a, b)], [np.maximum(x[:, :2], x[:, 2:]) for x in (a, b)]
    sweeps = []
    for k in (0, 1):
        order = np.argsort(los[1][:, k], kind="stable")
        low = los[1][order, k]
        first = np.searchsorted(low, los[0][:, k] - (his[1][:, k] - los[1][:, k]).max(initial=0), "left")
        past = np.searchsorted(low, his[0][:, k], "right")
        sweeps.append((int(np.maximum(0, past - first).sum()), order, first, np.maximum(0, past - first)))
    _, order, first, n = min(sweeps, key=lambda x: x[0])
    ends = np.cumsum(n)
    lo = 0
    while lo < len(a):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + at_once, "right")))
        m = n[lo:hi]
        i = np.repeat(np.arange(lo, lo + len(m)), m)
        j = order[np.repeat(first[lo:hi], m) + np.arange(len(i)) - np.repeat(np.cumsum(m) - m, m)]
        lo = hi
        near = ((los[0][i] <= his[1][j]) & (his[0][i] >= los[1][j])).all(1)
        i, j = i[near], j[near]
        p, q = a[i].T, b[j].T
        d1, d2 = _orient(q[0], q[1], q[2], q[3], p[0], p[1]), _orient(q[0], q[1], q[2], q[3], p[2], p[3])
        d3, d4 = _orient(p[0], p[1], p[2], p[3], q[0], q[1]), _orient(p[0], p[1], p[2], p[3], q[2], q[3])
        meet = (d1 * d2 <= 0) & (d3 * d4 <= 0)
        proper = meet & (((d1 * d2 < 0) & (d3 * d4 < 0)) | ((d1 == 0) & (d2 == 0)))
        yield i[meet], j[meet], proper[meet]


def _inside(point: np.ndarray, ring: np.ndarray) -> int:
    """1 inside, 0 on the ring, -1 outside."""
    x, y = point
    a, b = ring[:-1], ring[1:]
    on = (_orient(a[:, 0], a[:, 1], b[:, 0], b[:, 1], x, y) == 0) & (np.minimum(a[:, 0], b[:, 0]) <= x) & (x <= np.maximum(a[:, 0], b[:, 0])) & (np.minimum(a[:, 1], b[:, 1]) <= y) & (y <= np.maximum(a[:, 1], b[:, 1]))
    if on.any():
        return 0
    cross = (a[:, 1] > y) != (b[:, 1] > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        hit = x < (b[:, 0] - a[:, 0]) * (y - a[:, 1]) / (b[:, 1] - a[:, 1]) + a[:, 0]
    return 1 if (cross & hit).sum() % 2 else -1


def _few_simple(p: list[tuple[float, float]]) -> bool:
    """As `_simple` for a closed ring of few points without repeats, in plain arithmetic."""
    n = len(p) - 1

    def turn(a, b, c):
        v = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        return (v > 0) - (v < 0)

    for i in range(n):
        a, b = p[i], p[i + 1]
        c = p[(i + 2) % n]
        if turn(a, b, c) == 0 and (b[0] - a[0]) * (c[0] - b[0]) + (b[1] - a[1]) * (c[1] - b[1]) < 0:
            return False  # back along itself
        for j in range(i + 2, n):
            if i == 0 and j == n - 1:
                continue
            c, d = p[j], p[j + 1]
            if max(a[0], b[0]) < min(c[0], d[0]) or max(c[0], d[0]) < min(a[0], b[0]) or max(a[1], b[1]) < min(c[1], d[1]) or max(c[1], d[1]) < min(a[1], b[1]):
                continue
            if turn(a, b, c) * turn(a, b, d) <= 0 and turn(c, d, a) * turn(c, d, b) <= 0:
                return False
    return True


def _simple(ring: np.ndarray) -> bool:
    if len(ring) < 4 or not np.isfinite(ring).all() or (ring[0] != ring[-1]).any():
        return False
    keep = np.r_[True, (np.diff(ring, axis=0) != 0).any(1)]
    ring = ring[keep]
    if len(ring) < 4 or not abs(signed_area(ring)) > 0:
        return False
    if len(ring) <= 24:
        return _few_simple([tuple(x) for x in ring.tolist()])
    return _many_simple(ring)


def _many_simple(ring: np.ndarray) -> bool:
    """As `_few_simple`, by a sweep over all segments."""
    s, n = _segments(ring), len(ring) - 1
    for i, j, proper in _meetings(s, s):
        gap = (j - i) % n
        # neighbours share their common point only; others must not meet at all
        if (proper & (gap != 0) & ((gap != 1) & (gap != n - 1))).any() or ((gap > 1) & (gap < n - 1)).any():
            return False
        at = np.flatnonzero((gap == 1) & (i != j))
        if len(at):
            p, q = s[i[at]], s[j[at]]
            back = (_orient(*p.T, q[:, 2], q[:, 3]) == 0) & (((p[:, 2:] - p[:, :2]) * (q[:, 2:] - q[:, :2])).sum(1) < 0)
            if back.any():
                return False
    return True


def _apart(outer: np.ndarray, other: np.ndarray, want: int) -> bool:
    """No crossing of two rings, and `other` on the wanted side of `outer` (1 inside, -1 outside)."""
    for _, _, proper in _meetings(_segments(outer), _segments(other)):
        if proper.any():
            return False
    sides = {_inside(p, outer) for p in other[:-1]}
    return -want not in sides


def is_usable(rings: Rings | None) -> bool:
    """Closed simple rings of four points or more, finite, with area; holes inside their shell, parts not overlapping."""
    if not rings or not all(_simple(r) for p in rings for r in p):
        return False
    for p in rings:
        shell, holes = p[0], p[1:]
        if not all(_apart(shell, h, 1) for h in holes) or not all(_apart(a, b, -1) and _apart(b, a, -1) for k, a in enumerate(holes) for b in holes[k + 1 :]):
            return False
    for k, a in enumerate(rings):
        for b in rings[k + 1 :]:
            if not (_apart(a[0], b[0], -1) and _apart(b[0], a[0], -1)) and not any(_apart(h, b[0], 1) for h in a[1:]) and not any(_apart(h, a[0], 1) for h in b[1:]):
                return False
    total = area(rings)
    return math.isfinite(total) and total > 0


def _measure(key_type: str, parse: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for g in b.column("geometry").to_pylist():
                rings = parse(g)
                ok = is_usable(rings)
                c = centroid(rings) if ok else None
                box = bounds(rings) if ok else (None,) * 4
                out.append((rings is not None, ok, area(rings) if ok else None, *(c or (None, None)), *box, sum(len(r) for p in rings for r in p) if rings else 0))
            cols = list(zip(*out)) or [[]] * 10
            names = ("parsed", "usable", "area", "cx", "cy", "west", "south", "east", "north", "points")
            kinds = [pa.bool_()] * 2 + [pa.float64()] * 7 + [pa.int64()]
            yield pa.record_batch([b.column("key"), *[pa.array(c, k) for c, k in zip(cols, kinds)]], ["key", *names])

    return run


MEASURES = "parsed boolean, usable boolean, area double, cx double, cy double, west double, south double, east double, north double, points long"


def measures(df: DataFrame, key: str = "polygon_id", geometry: str = "geometry", wkb: bool = False) -> DataFrame:
    """(key, parsed, usable, area, cx, cy, west, south, east, north, points) of every row; one row in, one row out.

    Null, cut-off or self-crossing geometries are not usable and have null measures. Nothing is repaired.
    """
    rows = df.select(F.col(key).alias("key"), F.col(geometry).alias("geometry"))
    kind = rows.schema["key"].dataType.simpleString()
    return spread(rows).mapInArrow(_measure(kind, from_wkb if wkb else from_geojson), f"key {kind}, {MEASURES}").withColumnRenamed("key", key)
