"""Raster tiles: a small reader of single-band byte GeoTIFF (no compression or DEFLATE, strips or tiles) into blocks."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..operators.zonal import GRID, RASTER, blocks_of

_SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 11: 4, 12: 8, 16: 8}
_CODES = {1: "B", 3: "H", 4: "I", 11: "f", 12: "d", 16: "Q"}


def tags_of(data: bytes) -> dict[int, tuple]:
    """The tags of the first image of a TIFF; values are read, image data is not."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF")
    (at,) = struct.unpack_from(order + "I", data, 4)
    (n,) = struct.unpack_from(order + "H", data, at)
    tags: dict[int, tuple] = {}
    for k in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * k)
        if kind not in _CODES:
            continue
        size = _SIZES[kind] * count
        place = at + 10 + 12 * k if size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * k)[0]
        tags[tag] = struct.unpack_from(f"{order}{count}{_CODES[kind]}", data, place)
    return tags


#: Keys of the tag that says the plane of a raster, and the codes of geographic coordinates on WGS 84.
GEOKEYS, MODEL_TYPE, GEOGRAPHIC, GEOGRAPHIC_TYPE, WGS84 = 34735, 1024, 2, 2048, 4326


def layout(tags: dict[int, tuple]) -> tuple[int, int, tuple[float, float, float, float]]:
    """(width, height, (x0, y0, dx, dy)) of a band that can be read; ValueError for another layout, plane or direction."""
    if tags.get(259, (1,))[0] not in (1, 5, 8, 32946) or tags.get(258, (8,))[0] != 8 or tags.get(277, (1,))[0] != 1 or tags.get(317, (1,))[0] not in (1, 2):
        raise ValueError("unsupported layout")
    keys = tags.get(GEOKEYS)
    if keys:
        known = {keys[k]: keys[k + 3] for k in range(4, len(keys) - 3, 4) if keys[k + 1] == 0}
        if known.get(MODEL_TYPE, GEOGRAPHIC) != GEOGRAPHIC or known.get(GEOGRAPHIC_TYPE, WGS84) != WGS84:
            raise ValueError("raster is not in geographic WGS 84 coordinates")
    if 33550 not in tags or 33922 not in tags:
        raise ValueError("raster is not north-up, or has no place")
    scale, tie = tags[33550], tags[33922]
    if scale[0] <= 0 or scale[1] <= 0:
        raise ValueError("raster is not north-up, or has no place")
    return tags[256][0], tags[257][0], (tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1], scale[0], scale[1])


def _lzw(data: bytes) -> bytes:
    """LZW of TIFF: codes of 9 to 12 bits, highest bit first, 256 clears the table, 257 ends."""
    out, table, width, bits, have, last = bytearray(), [], 9, 0, 0, b""
    for byte in data:
        bits, have = bits << 8 | byte, have + 8
        while have >= width:
            have -= width
            code, bits = bits >> have, bits & (1 << have) - 1
            if code == 257:
                return bytes(out)
            if code == 256:
                table, width, last = [bytes((k,)) for k in range(256)] + [b"", b""], 9, b""
                continue
            now = table[code] if code < len(table) else last + last[:1]
            out += now
            if last:
                table.append(last + now[:1])
            last = now
            width = 9 + (len(table) >= 511) + (len(table) >= 1023) + (len(table) >= 2047)
    return bytes(out)


def decode(data: bytes, window: tuple[int, int, int, int] | None = None) -> tuple[np.ndarray, tuple[float, float, float, float]]:
    """(band, (x0, y0, dx, dy)) of a north-up tile, or of its `window` (row, column, height, width); raises ValueError for what it does not read.

    Only the strips or tiles that meet the window are unpacked.
    """
    tags = tags_of(data)
    width, height, (x0, y0, dx, dy) = layout(tags)
    packed, predictor = tags.get(259, (1,))[0], tags.get(317, (1,))[0]
    unpack = {1: lambda b: b, 5: _lzw}.get(packed, zlib.decompress)
    top, left, tall, wide = window or (0, 0, height, width)
    top, left = max(0, top), max(0, left)
    tall, wide = max(0, min(height - top, tall)), max(0, min(width - left, wide))
    band = np.zeros((tall, wide), np.uint8)
    if 324 in tags:
        tw, th = tags[322][0], tags[323][0]
        parts = zip(tags[324], tags[325])
    else:
        tw, th = width, min(height, tags.get(278, (height,))[0])
        parts = zip(tags[273], tags[279])
    across = -(-width // tw)
    for k, (off, size) in enumerate(parts):
        i, j = k // across * th, k % across * tw
        a, b, c, d = max(i, top), min(i + th, top + tall), max(j, left), min(j + tw, left + wide)
        if a >= b or c >= d:
            continue
        part = np.frombuffer(unpack(data[off : off + size]), np.uint8)
        part = part[: len(part) // tw * tw].reshape(-1, tw)
        if predictor == 2:  # each value is told by its difference to the one before
            part = np.cumsum(part, axis=1, dtype=np.uint8)
        band[a - top : b - top, c - left : d - left] = part[a - i : b - i, c - j : d - j]
    return band, (x0 + left * dx, y0 - top * dy, dx, dy)


def encode(band: np.ndarray, x0: float, y0: float, dx: float, dy: float, deflate: bool = True) -> bytes:
    """A GeoTIFF that `decode` reads, in one strip."""
    body = zlib.compress(band.tobytes()) if deflate else band.tobytes()
    h, w = band.shape
    tags = [(256, 4, (w,)), (257, 4, (h,)), (258, 3, (8,)), (259, 3, (8 if deflate else 1,)), (262, 3, (1,)), (273, 4, (0,)), (277, 3, (1,)), (278, 4, (h,)), (279, 4, (len(body),)), (33550, 12, (dx, dy, 0.0)), (33922, 12, (0.0, 0.0, 0.0, x0, y0, 0.0))]
    head = 8 + 2 + 12 * len(tags) + 4
    extra, entries = b"", b""
    strip = head + sum(_SIZES[k] * len(v) for _, k, v in tags if _SIZES[k] * len(v) > 4)
    for tag, kind, values in tags:
        if tag == 273:
            values = (strip,)
        raw = struct.pack(f"<{len(values)}{_CODES[kind]}", *values)
        entries += struct.pack("<HHI", tag, kind, len(values)) + (raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack("<I", head + len(extra)))
        extra += raw if len(raw) > 4 else b""
    return b"II" + struct.pack("<HI", 42, 8) + struct.pack("<H", len(tags)) + entries + struct.pack("<I", 0) + extra + body


NAME = re.compile(r"([NS])(\d{2})([EW])(\d{3})")


def _corner(name: str) -> tuple[str, int, int]:
    m = NAME.search(name)
    if not m:
        raise ValueError(f"no tile name in {name}")
    return m[0], (1 if m[1] == "N" else -1) * int(m[2]), (1 if m[3] == "E" else -1) * int(m[4])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
            tile = _corner(path.rsplit("/", 1)[-1])[0]
            cols = list(zip(*[(tile, *x) for x in blocks_of(decode(data)[0])]))
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], ["tile", "brow", "bcol", "height", "width", "codes"])


def _grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Headers only: nothing is unpacked to learn a tile's place."""
    for b in batches:
        rows = []
        for path, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist()):
            width, height, place = layout(tags_of(data))
            rows.append((*_corner(path.rsplit("/", 1)[-1]), *place, width, height))
        kinds = (pa.string(), pa.int32(), pa.int32(), *[pa.float64()] * 4, pa.int32(), pa.int32())
        names = [x.split()[0] for x in GRID.split(", ")]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 9, kinds)], names)


def read_tiles(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(grids, raster) of a folder of tiles named by their south-west corner; files are decoded where they are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif").load(path).select("path", "content")
    return files.mapInArrow(_grid, GRID), files.mapInArrow(_blocks, RASTER)


def read_tile_files(spark: SparkSession, paths: list[str]) -> tuple[DataFrame, DataFrame]:
    """As `read_tiles`, of the named files only."""
    if not paths:
        return spark.createDataFrame([], GRID), spark.createDataFrame([], RASTER)
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInArrow(_grid, GRID), files.mapInArrow(_blocks, RASTER)
