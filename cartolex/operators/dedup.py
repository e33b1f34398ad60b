"""The global pass: one region per object, one record per text and label, one split per document; and what it removes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.runtime import materialise
from ..functions.text import dedup_key, normalise


def _first(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per key, the first of a total order; the group limit of the planner cuts groups before the shuffle."""
    ranked = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rn = 1").drop("_rn")


def home_region(rows: DataFrame) -> DataFrame:
    """Rows of the first region (by name) of each object; rows of null ids drop out."""
    home = rows.where("osm_type is not null and osm_id is not null").groupBy("osm_type", "osm_id").agg(F.min("region").alias("region"))
    return rows.join(home, ["osm_type", "osm_id", "region"], "left_semi")


def dedup_objects(rows: DataFrame, tie: str = "example_id") -> DataFrame:
    """One row per object and document: the smallest polygon id, then the smallest `tie`."""
    return _first(rows, ["osm_type", "osm_id", "document_id"], [F.asc_nulls_last("polygon_id"), F.asc_nulls_last(tie)])


def with_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("dedup_key", dedup_key(F.col("text"), F.col("worldcover_code")))


def dedup_examples(rows: DataFrame, tie: str = "example_id") -> DataFrame:
    """One row per polygon, text and label: the smallest document id, then the smallest `tie`."""
    return _first(rows, ["polygon_id", "dedup_key"], [F.asc_nulls_last("document_id"), F.asc_nulls_last(tie)])


def document_home(rows: DataFrame) -> DataFrame:
    """Rows in the split that holds most rows of their document; ties go to the first split by name.

    The window runs over counts of (document, split), at most one per split, never over rows.
    """
    counts = rows.where("document_id is not null").groupBy("document_id", "split").agg(F.count("*").alias("n"))
    best = counts.groupBy("document_id").agg(F.min(F.struct((-F.col("n")).alias("n"), "split"))["split"].alias("split"))
    return rows.join(best, ["document_id", "split"], "left_semi")


def chain(rows: DataFrame) -> dict[str, DataFrame]:
    """The steps by name: home, objects, examples, kept.

    The key is computed where rows are read, so that steps which need no text move its digest instead.
    """
    home = home_region(with_key(rows))
    objects = dedup_objects(home)
    examples = dedup_examples(objects)
    return {"home": home, "objects": objects, "examples": examples, "kept": document_home(examples)}


NARROW = ("example_id", "osm_type", "osm_id", "region", "polygon_id", "document_id", "dedup_key", "split")


def kept_ids(rows: DataFrame) -> DataFrame:
    """(example_id) of the rows that all steps keep: only narrow rows are shuffled by the steps."""
    narrow = with_key(rows).select(*NARROW)
    return document_home(dedup_examples(dedup_objects(home_region(narrow)))).select("example_id")


def stats(rows: DataFrame) -> DataFrame:
    """(step, rows_kept) of every step; each step is written once and counted from there."""
    home = materialise(home_region(with_key(rows).select(*NARROW)))
    objects = materialise(dedup_objects(home))
    examples = materialise(dedup_examples(objects))
    steps = {"input": rows, "home": home, "objects": objects, "examples": examples, "kept": document_home(examples)}
    out = None
    for name, df in steps.items():
        one = df.agg(F.count("*").alias("rows_kept")).select(F.lit(name).alias("step"), "rows_kept")
        out = one if out is None else out.unionByName(one)
    return out


def duplicate_groups(objects: DataFrame) -> DataFrame:
    grouped = objects.groupBy("polygon_id", "dedup_key").agg(F.min("text_words").alias("words"), F.count("*").alias("n"), F.countDistinct("split").alias("splits"))
    return grouped.where("n > 1")


def duplicate_summary(objects: DataFrame) -> DataFrame:
    """(dup_groups, removed, cross_groups, cross_removed) under the polygon-text-label key."""
    cross = F.col("splits") > 1
    return duplicate_groups(objects).agg(
        F.count("*").alias("dup_groups"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed"),
        F.count_if(cross).alias("cross_groups"), F.coalesce(F.sum(F.when(cross, F.col("n") - 1)), F.lit(0)).alias("cross_removed"),
    )


def duplicates_by_words(objects: DataFrame) -> DataFrame:
    """(words, removed) for 1..9 words and `10+`, zeros included."""
    bucket = F.when(F.col("words") < 10, F.col("words").cast("string")).otherwise("10+")
    found = duplicate_groups(objects).groupBy(bucket.alias("words")).agg(F.sum(F.col("n") - 1).alias("removed"))
    all_ = objects.sparkSession.createDataFrame([(str(k),) for k in range(1, 10)] + [("10+",)], "words string")
    return all_.join(found, "words", "left").select("words", F.coalesce("removed", F.lit(0)).alias("removed"))


def group_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(n_groups, n_rows, cross_groups, cross_rows) over keys that several rows hold."""
    grouped = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.countDistinct("split").alias("splits")).where("n > 1")
    cross = F.col("splits") > 1
    return grouped.agg(
        F.count("*").alias("n_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count_if(cross).alias("cross_groups"), F.coalesce(F.sum(F.when(cross, F.col("n"))), F.lit(0)).alias("cross_rows")
    )


def retained_text(kept: DataFrame) -> DataFrame:
    """The counters of `group_counts` for equal text and label, and for equal text."""
    by_text = kept.withColumn("text_key", F.sha2(normalise(F.col("text")), 256))
    a = group_counts(kept, ["dedup_key"]).select(F.lit("text_label").alias("key_kind"), "*")
    return a.unionByName(group_counts(by_text, ["text_key"]).select(F.lit("text").alias("key_kind"), "*"))
