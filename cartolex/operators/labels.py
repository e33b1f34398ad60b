"""Labels by dominance: the class that covers enough of a polygon, or why there is none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import AREA_CAP_M2, CLASSES, OVERSHOOT, THRESHOLD


def label_for(code: Column) -> Column:
    """The label of a class code; null for codes that are no class."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in CLASSES.items() for x in kv]), code.cast("int"))


def known_label(code: Column) -> Column:
    """The label of a class code; a code that is no class fails the query, and null stays null."""
    return F.when(code.isNotNull(), F.coalesce(label_for(code), F.raise_error(F.concat(F.lit("no land-cover class: "), code.cast("string"))).cast("string")))


def within_area_cap(area: Column, cap: float | None = AREA_CAP_M2) -> Column:
    """True up to the cap; null and NaN areas are not within it; no cap lets all pass."""
    return F.lit(True) if cap is None else F.coalesce((area <= cap) & ~F.isnan(area), F.lit(False))


def dominance(coverage: DataFrame, key: str = "polygon_id", code: str = "code", area: str = "area", whole: str = "polygon_area", threshold: float = THRESHOLD) -> DataFrame:
    """(key, accepted, code, fraction, observed, reason) for each polygon of a long coverage table.

    Rows of one class are summed first. Shares are of the polygon, clamped to [0, 1]; more than one per cent too much
    in all is refused; only known classes compete; ties go to the lowest code.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be in (0, 1]")
    by_class = coverage.groupBy(key, F.col(code).cast("int").alias("_c")).agg(F.sum(area).alias("_a"), F.max(whole).alias("_w"))
    share = F.least(F.greatest(F.try_divide(F.col("_a"), F.col("_w")), F.lit(0.0)), F.lit(1.0))
    rows = by_class.withColumn("_s", share).withColumn("_k", F.when(F.col("_c").isin(*CLASSES), F.struct((-F.col("_s")).alias("s"), F.col("_c").alias("c"))))
    best = rows.groupBy(key).agg(F.max("_w").alias("_w"), F.sum("_a").alias("_t"), F.min("_k").alias("_k"), F.sum(F.try_divide(F.col("_a"), F.col("_w"))).alias("observed"))
    empty = ~F.coalesce(F.col("_w") > 0, F.lit(False))
    none = F.col("_k").isNull() | (F.col("_t") > F.col("_w") * (1 + OVERSHOOT))
    fraction = F.when(empty | none, F.lit(0.0)).otherwise(-F.col("_k.s"))
    reason = F.when(empty, "empty_polygon").when(none, "no_valid_class").when(fraction < threshold, "below_threshold")
    return best.select(key, reason.isNull().alias("accepted"), F.when(~(empty | none), F.col("_k.c")).alias("code"), fraction.alias("fraction"), F.coalesce("observed", F.lit(0.0)).alias("observed"), reason.alias("reason"))


def rejections(verdicts: DataFrame) -> DataFrame:
    """(reason, n) over refused polygons."""
    return verdicts.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))
