"""Splits by hashing spatial cells."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import SEED, SPLITS


def unit_hash(cell: Column, seed: int = SEED) -> Column:
    """The first eight bytes of SHA-256(`seed:cell`) as a number in [0, 1)."""
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), cell), 256), 1, 16)
    return F.conv(head, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(float(1 << 64))


def assign_split(unit: Column, splits: tuple[tuple[str, float], ...] = SPLITS) -> Column:
    """Left-closed intervals of the unit range, in order; the last split takes the rest."""
    total = sum(s for _, s in splits)
    if abs(total - 1) > 1e-9 or any(s < 0 for _, s in splits):
        raise ValueError("shares must not be negative and must sum to one")
    upper, out = 0.0, None
    for name, share in splits[:-1]:
        upper = upper + share
        out = (F if out is None else out).when(unit < F.lit(upper), F.lit(name))
    return F.when(unit.isNotNull(), out.otherwise(F.lit(splits[-1][0])) if out is not None else F.lit(splits[-1][0]))


def block_cell(lat: Column, lon: Column, resolution: int) -> Column:
    """A cell id that is a pure function of place and resolution: blocks of latitude rows with about equal area.

    Rows are 180 / (4 * 2^resolution) degrees high; a row has as many columns as keep cells about as wide as high at
    its middle. Null or invalid coordinates have no cell. These ids are not those of any public hexagon grid.
    """
    rows = 4 << resolution
    ok = lat.between(-90, 90) & lon.between(-180, 180)
    row = F.least(F.floor((lat + 90) * (rows / 180)), F.lit(rows - 1))
    middle = F.radians((row + 0.5) * (180 / rows) - 90)
    columns = F.greatest(F.lit(1), F.floor(F.cos(middle) * (2 * rows) + 0.5))
    column = F.least(F.floor((lon + 180) / 360 * columns), columns - 1)
    return F.when(ok, F.concat_ws("_", F.lit(f"b{resolution}"), row.cast("string"), column.cast("string")))


def cell_for(lat: Column, lon: Column, resolution: int = 5, indexer: Callable[[Column, Column, int], Column] = block_cell) -> Column:
    """The cell of a place under a pluggable indexer; everything behind it needs only a pure function of the place."""
    return indexer(lat, lon, resolution)
