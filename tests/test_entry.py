"""Every query with SQL gives the rows that the SQL gives, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from cartolex import queries as core

SLOW = {"zonal_coverage", "raster_cells"}


@pytest.fixture(scope="module")
def tables(sf):
    c = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def value(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "~"
    return repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def rows(records, names):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted("|".join(value(r[k]) for k in order) for r in records)


@pytest.mark.parametrize("name", sorted(set(core.SQL) - SLOW))
def test_query_equals_sql(spark, sf, tables, name):
    df = core.QUERIES[name](spark, sf)
    cur = tables.execute(core.SQL[name])
    names = [x[0] for x in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(map(tuple, df.collect()), df.columns) == rows(cur.fetchall(), names)


def test_entry_has_rows(spark, sf):
    assert entry.entry(spark).count() == 4


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(core.SQL) <= set(core.QUERIES)
