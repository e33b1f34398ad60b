"""Counts, distributions, quantiles and extents of a release."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.runtime import discard, materialise
from ..functions.text import normalise
from ..schema import SPLITS


def split_counts(kept: DataFrame) -> DataFrame:
    """(split, examples, polygons, documents) for every split in order, zeros included, and their total of rows."""
    aggs = [F.count("*").alias("examples"), F.countDistinct("polygon_id").alias("polygons"), F.countDistinct("document_id").alias("documents")]
    by = kept.groupBy("split").agg(*aggs)
    names = kept.sparkSession.createDataFrame([(n,) for n, _ in SPLITS], "split string")
    filled = names.join(by, "split", "left").na.fill(0)
    total = filled.agg(*[F.sum(c).alias(c) for c in ("examples", "polygons", "documents")]).select(F.lit("total").alias("split"), "*")
    return filled.unionByName(total)


def distribution(kept: DataFrame, column: str) -> DataFrame:
    """(column, n, share): null is a group of its own; shares have six decimals."""
    by = kept.groupBy(column).agg(F.count("*").alias("n"))
    return by.select(column, "n", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6).alias("share"))


def by_frequency(counts: DataFrame, column: str) -> list:
    """The order of language lists: most frequent first, null last among equals, then by name."""
    return [F.desc("n"), F.col(column).isNull(), F.coalesce(F.col(column), F.lit(""))]


def order_statistics(df: DataFrame, column: str, shares: tuple[float, ...]) -> list[float | None]:
    """Exact, interpolated quantiles of the values that are not null; None for an empty column.

    Equal values are counted where they are, distinct ones dealt to ranges; counts before each range tell which rows hold
    the wanted places, so no task orders or holds all values.
    """
    by = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("v")).agg(F.count("*").alias("n"))
    parts = materialise(by.repartitionByRange("v").withColumn("p", F.spark_partition_id()))
    sizes = {r["p"]: r["n"] for r in parts.groupBy("p").agg(F.sum("n").alias("n")).collect()}
    whole = sum(sizes.values())
    if not whole:
        return [None] * len(shares)
    before, at = {}, 0
    for p in sorted(sizes):
        before[p], at = at, at + sizes[p]
    wanted = sorted({k for q in shares for k in (int(q * (whole - 1)), min(whole - 1, int(q * (whole - 1)) + 1))})
    hold = [p for p in sizes if any(before[p] <= k < before[p] + sizes[p] for k in wanted)]
    first = F.element_at(F.create_map(*[F.lit(x) for p in hold for x in (p, before[p])]), F.col("p"))
    upto = F.sum("n").over(Window.partitionBy("p").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = parts.where(F.col("p").isin(hold)).withColumn("past", first + upto).withColumn("k", F.filter(F.array(*map(F.lit, wanted)), lambda k: (k < F.col("past")) & (k >= F.col("past") - F.col("n"))))
    value = {k: r["v"] for r in rows.where(F.size("k") > 0).select("v", "k").collect() for k in r["k"]}
    discard(parts)
    out = []
    for q in shares:
        place = q * (whole - 1)
        low = int(place)
        a, b = value[low], value[min(whole - 1, low + 1)]
        out.append(a + (b - a) * (place - low))
    return out


def quantiles(kept: DataFrame, column: str = "dominant_fraction") -> DataFrame:
    """Exact, interpolated p50, p90 and p99 with six decimals, as one row."""
    q = [None if x is None else round(x, 6) for x in order_statistics(kept, column, (0.5, 0.9, 0.99))]
    return kept.sparkSession.createDataFrame([tuple(q)], "p50 double, p90 double, p99 double")


def bbox(kept: DataFrame) -> DataFrame:
    """Extent over finite coordinates."""
    ok = lambda c: F.when(F.abs(c) < float("inf"), F.col(c))
    return kept.agg(F.min(ok("lon")).alias("west"), F.min(ok("lat")).alias("south"), F.max(ok("lon")).alias("east"), F.max(ok("lat")).alias("north"))


def coverage_stats(kept: DataFrame) -> DataFrame:
    return kept.agg(F.countDistinct("h3_cell").alias("cells"), F.countDistinct("region").alias("regions"))


def top_named(kept: DataFrame) -> DataFrame:
    """(worldcover_code, name, worldcover_label) of one named polygon per class: first by lower-cased name, polygon, document."""
    name = F.trim("name")
    tie = [F.asc_nulls_last("example_id")] if "example_id" in kept.columns else []
    order = Window.partitionBy("worldcover_code").orderBy(F.lower(name).asc_nulls_last(), F.asc_nulls_last("polygon_id"), F.asc_nulls_last("document_id"), *tie)
    named = kept.where(F.length(name) > 0).withColumn("rn", F.row_number().over(order)).where("rn = 1")
    return named.select("worldcover_code", name.alias("name"), "worldcover_label")


def centroids(rows: DataFrame, refuse: bool = False) -> DataFrame:
    """One point per polygon; `refuse` raises where rows of a polygon disagree and names five of them, else the smallest values stand."""
    if refuse and (bad := [r[0] for r in polygon_conflicts(rows).orderBy("polygon_id").limit(5).collect()]):
        raise ValueError(f"rows of a polygon disagree in class, label or place: {bad}")
    by = rows.where("worldcover_code is not null and worldcover_label is not null").groupBy("polygon_id")
    return by.agg(F.min("lat").alias("lat"), F.min("lon").alias("lon"), F.min("worldcover_code").cast("int").alias("worldcover_code"), F.min("worldcover_label").alias("worldcover_label"))


def polygon_conflicts(rows: DataFrame) -> DataFrame:
    """Polygons with several codes, labels or places."""
    by = rows.where("worldcover_code is not null and worldcover_label is not null").groupBy("polygon_id")
    counts = by.agg(*[F.countDistinct(c).alias(c) for c in ("worldcover_code", "worldcover_label", "lat", "lon")])
    return counts.where("worldcover_code > 1 or worldcover_label > 1 or lat > 1 or lon > 1").select("polygon_id")


def normalised_texts(rows: DataFrame) -> DataFrame:
    return rows.select("example_id", normalise(F.col("text")).alias("text_norm"))
