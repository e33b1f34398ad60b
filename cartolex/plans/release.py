"""Writing a release: ordered splits, counts beside them, and the same bytes when built again."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.runtime import discard, materialise
from ..operators import checks, dedup, summary
from ..schema import CLASSES, RELEASE, SPLITS

ROW_GROUP = 25_000
#: Language labels that a manifest names, the most frequent first; the driver holds no more of them.
NAMED = 1000


def ordered_places(rows: DataFrame, split: str, order: list[str]) -> DataFrame:
    """Rows with their place (from 1) in the total order of their split.

    Rows are range-partitioned and ranked inside ranges; counts before each range are added. No task sorts a whole split.
    """
    keys = [F.asc_nulls_last(c) for c in order]
    parts = materialise(rows.repartitionByRange(F.col(split).asc_nulls_last(), *keys).withColumn("_r", F.spark_partition_id()))
    counts = parts.groupBy(split, "_r").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(split).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(split).alias("_s"), F.col("_r").alias("_q"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = F.row_number().over(Window.partitionBy(split, "_r").orderBy(*keys))
    placed = parts.withColumn("_k", local).join(F.broadcast(starts), (F.col("_r") == F.col("_q")) & F.col(split).eqNullSafe(F.col("_s")))
    return placed.withColumn("place", F.col("_start") + F.col("_k")).drop("_r", "_q", "_s", "_start", "_k")


def write_splits(kept: DataFrame, folder: str, order: tuple[str, ...] = ("polygon_id", "document_id", "example_id"), single_file: bool = False) -> None:
    """One folder per split in total order, zstd, fixed row groups; an empty split is written too.

    Files follow ranges of the order, so reading them by name gives the order; `single_file` is for small releases
    that must be one file.
    """
    for name, _ in SPLITS:
        part = kept.where(F.col("split") == name)
        keys = [F.asc_nulls_last(c) for c in order if c in kept.columns]
        part = part.orderBy(*keys).coalesce(1) if single_file else part.orderBy(*keys)
        part.write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", ROW_GROUP).parquet(f"{folder}/{name}.parquet")


def manifest(kept: DataFrame, settings: dict | None = None, rejections: dict | None = None, deduplication: dict | None = None, analysis: dict | None = None, processing: dict | None = None) -> dict:
    """The counts of a release as plain values, with its settings and where its rows went.

    `language_distribution` names the NAMED most frequent labels; `languages_other` counts the rest. Shares and quantiles are
    rounded on the driver, half to even, so that a reader of the file can work them out again.
    """
    by = {r["split"]: r.asDict() for r in summary.split_counts(kept).collect()}
    order = [*(n for n, _ in SPLITS), "total"]
    counts = {c: {k: int(by[k][c]) for k in order} for c in ("examples", "polygons", "documents")}
    total = counts["examples"]["total"]
    share = lambda n: round(n / total, 6) if total else 0.0
    classes = summary.distribution(kept, "worldcover_code").orderBy("worldcover_code").collect()
    langs = materialise(summary.distribution(kept, "language").drop("share"))
    ordered = langs.orderBy(*summary.by_frequency(langs, "language")).limit(NAMED).collect()
    # Labels are free text: what is not named is counted as one, so that the counts add up to the release.
    all_ = langs.agg(F.count("*").alias("labels"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    rest = all_["n"] - sum(r["n"] for r in ordered)
    q = summary.order_statistics(kept, "dominant_fraction", (0.5, 0.9, 0.99))
    box, cover = summary.bbox(kept).first(), summary.coverage_stats(kept).first()
    return {
        "counts": counts,
        "class_distribution": [{"code": r["worldcover_code"], "label": CLASSES.get(r["worldcover_code"]), "examples": r["n"], "share": share(r["n"])} for r in classes],
        "language_distribution": [{"language": r["language"], "examples": r["n"], "share": share(r["n"])} for r in ordered],
        "languages_other": {"labels": all_["labels"] - len(ordered), "examples": rest, "share": share(rest)},
        "example_polygons": [r.asDict() for r in summary.top_named(kept).orderBy("worldcover_code").collect()],
        "dominant_fraction": {k: round(v, 6) for k, v in zip(("p50", "p90", "p99"), q) if v is not None},
        "geographic_coverage": {"h3_cells": cover["cells"], "regions": cover["regions"], "bbox": {"min_lon": box["west"], "min_lat": box["south"], "max_lon": box["east"], "max_lat": box["north"]}},
        "rejections": dict(sorted((rejections or {}).items())), "deduplication": dict(sorted((deduplication or {}).items())), "deduplication_analysis": analysis or {},
        "settings": settings or {}, "processing": processing or {},
    }


def retained(kept: DataFrame) -> dict[str, int]:
    """The counters of equal texts that a release keeps."""
    r = {x["key_kind"]: x for x in dedup.retained_text(kept if "dedup_key" in kept.columns else dedup.with_key(kept)).collect()}
    a, b = r["text_label"], r["text"]
    return {
        "retained_identical_text_label_groups": a["n_groups"], "retained_identical_text_label_rows": a["n_rows"], "retained_identical_text_label_cross_split_groups": a["cross_groups"],
        "retained_identical_text_label_cross_split_rows": a["cross_rows"], "identical_text_cross_split_groups": b["cross_groups"], "identical_text_cross_split_rows": b["cross_rows"],
    }


def global_pass(rows: DataFrame) -> tuple[DataFrame, dict[str, int], dict[str, object]]:
    """(kept, removed by each step, analysis of duplicates). Rows are numbered and written first: the number, not
    `example_id`, tells rows apart, so rows of equal id stay or go on their own. Every step moves narrow rows and is written.
    """
    if "example_id" not in rows.columns:
        rows = rows.withColumn("example_id", F.xxhash64("region", "polygon_id", "document_id", "text"))
    rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()))
    start = materialise(dedup.with_key(rows).select("_row", "text_words", *dedup.NARROW))
    home = materialise(dedup.home_region(start))
    objects = materialise(dedup.dedup_objects(home))
    examples = materialise(dedup.dedup_examples(objects))
    final = materialise(dedup.document_home(examples))
    kept = materialise(rows.join(final.select("_row"), "_row", "left_semi").drop("_row"))
    n = [df.count() for df in (start, home, objects, examples, final)]
    removed = dict(zip(("cross_region_records", "duplicate_object_documents", "duplicate_polygon_text_label_records", "document_split_conflicts"), (a - b for a, b in zip(n, n[1:]))))
    d = dedup.duplicate_summary(objects).first()
    analysis = {
        "duplicate_polygon_text_label_groups": d["dup_groups"], "duplicate_records_removed": d["removed"], "duplicate_record_groups_crossing_splits": d["cross_groups"],
        "duplicate_records_removed_from_cross_split_groups": d["cross_removed"], "duplicate_records_removed_by_text_words": {r["words"]: r["removed"] for r in dedup.duplicates_by_words(objects).collect()}, **retained(kept),
    }
    for step in (rows, start, home, objects, examples, final):
        discard(step)
    return kept, removed, analysis


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of any file system: written under another name, then renamed."""
    target, part = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{path}.part"))
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    fs.delete(target, False)
    if not fs.rename(part, target):
        raise OSError(f"could not write {path}")


def build(spark: SparkSession, rows: DataFrame, folder: str, settings: dict | None = None, rejections: dict | None = None, processing: dict | None = None, single_file: bool = False) -> dict:
    """The whole global pass: deduplicate, keep documents in one split, write ordered splits and the manifest, validate."""
    kept, removed, analysis = global_pass(rows)
    if settings:  # a release of the published schema
        kept = kept.select(*RELEASE.names)
    write_splits(kept, folder, single_file=single_file)
    out = manifest(kept, settings, rejections, removed, analysis, processing)
    found = checks.report(checks.release_violations(kept, *((settings["dominance_threshold"], settings["min_words"]) if settings else ()))).collect()
    out["violations"] = {r["code"]: r["n"] for r in found}
    write_text(spark, f"{folder}/manifest.json", json.dumps(out, indent=2, ensure_ascii=False) + "\n")
    return out
