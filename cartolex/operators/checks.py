"""Data-quality checks: violations of single rows and of the whole release, with counts and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.runtime import materialise
from ..functions.splits import assign_split, cell_for, unit_hash
from ..functions.text import dedup_key, normalise, text_hash, word_count
from ..schema import AREA_CAP_M2, MIN_WORDS, NULLABLE, RELEASE, SEED, SPLITS, THRESHOLD
from .labels import label_for

SPLIT_NAMES = tuple(n for n, _ in SPLITS)
SAMPLES = 5


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def is_full_revision(x: Column, upper: bool = False) -> Column:
    """Forty hexadecimal digits, in lower case unless `upper` allows either."""
    return F.coalesce(x.rlike("^[0-9a-fA-F]{40}$" if upper else "^[0-9a-f]{40}$"), F.lit(False))


def report(violations: DataFrame) -> DataFrame:
    """(code, n, samples): the count and the five smallest culprits, as often as they come, of each code of (code, culprit[, times]) rows.

    The checks run once: their rows are counted by culprit, with a partial step before the shuffle, and written. Null
    culprits come last; the group limit of the planner cuts each task's culprits to five before they meet.
    """
    weight = F.sum("times") if "times" in violations.columns else F.count("*")
    by = materialise(violations.groupBy("code", F.col("culprit").cast("string").alias("culprit")).agg(weight.alias("n")))
    ranked = by.withColumn("rn", F.row_number().over(Window.partitionBy("code").orderBy(F.asc_nulls_last("culprit")))).where(F.col("rn") <= SAMPLES)
    first = F.array_sort(F.collect_list(F.struct("rn", "culprit", "n")))
    again = F.flatten(F.transform(first, lambda x: F.array_repeat(x["culprit"], F.least(x["n"], F.lit(SAMPLES)).cast("int"))))
    some = ranked.groupBy("code").agg(F.slice(again, 1, SAMPLES).alias("samples"))
    return by.groupBy("code").agg(F.sum("n").alias("n")).join(some, "code")


def _codes(rows: DataFrame, checks: list[tuple[str, Column]], culprit: str = "polygon_id") -> DataFrame:
    marks = F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(name)) for name, c in checks]))
    return rows.select(F.explode(marks).alias("code"), F.col(culprit).alias("culprit"))


def release_violations(rows: DataFrame, threshold: float = THRESHOLD, least: int = MIN_WORDS) -> DataFrame:
    """(code, culprit, times) of every guarantee that a published row or key breaks; a record held n times counts n - 1 times."""
    f, split = F.col("dominant_fraction"), F.col("split")
    within = f.between(0, 1) & ~F.isnan(f)
    label = label_for(F.col("worldcover_code"))
    single = _codes(rows, [
        ("invalid_split", ~F.coalesce(split.isin(*SPLIT_NAMES), F.lit(False))), ("invalid_label", ~F.coalesce(label == F.col("worldcover_label"), F.lit(False))),
        ("invalid_fraction", ~F.coalesce(within, F.lit(False))), ("below_threshold", within & (f < threshold)), ("unusable_text", word_count(F.col("text")) < least),
    ])
    keyed = rows.where("worldcover_code is not null").select("polygon_id", dedup_key(F.col("text"), F.col("worldcover_code")).alias("k"))
    again = keyed.groupBy("polygon_id", "k").agg(F.count("*").alias("n")).where("n > 1")
    again = again.select(F.lit("duplicate_example").alias("code"), F.col("polygon_id").alias("culprit"), (F.col("n") - 1).alias("times"))
    once = F.lit(1).cast("long").alias("times")
    out = single.select("code", "culprit", once).unionByName(again)
    for column, code in (("polygon_id", "polygon_leakage"), ("document_id", "document_leakage")):
        out = out.unionByName(leaking(rows, column).select(F.lit(code).alias("code"), F.col("key").alias("culprit"), once))
    return out


def audit_violations(rows: DataFrame, settings: dict | None = None) -> DataFrame:
    """(code, culprit) of the independent audit of single rows: values, ranges, provenance, places and texts."""
    s = {"threshold": THRESHOLD, "cap": AREA_CAP_M2, "least": MIN_WORDS, "provenance": {}, "assignment": False} | (settings or {})
    checks: list[tuple[str, Column]] = [(f"required_null:{f.name}", F.col(f.name).isNull()) for f in RELEASE.fields if f.name not in NULLABLE]
    checks += [("invalid_split", ~F.coalesce(F.col("split").isin(*SPLIT_NAMES), F.lit(False))), ("invalid_label", ~label_for(F.col("worldcover_code")).eqNullSafe(F.col("worldcover_label")))]
    checks += [(f"provenance_mismatch:{k}", ~F.col(k).eqNullSafe(F.lit(v))) for k, v in s["provenance"].items()]
    checks += [(f"empty_identifier:{c}", F.coalesce(normalise(F.col(c)), F.lit("")) == "") for c in ("polygon_id", "document_id", "region", "source_pbf", "h3_cell")]
    for c in ("dominant_fraction", "observed_fraction"):
        checks.append((f"invalid_fraction:{c}", ~(finite(F.col(c)) & F.col(c).between(0, 1 + 1e-6))))
    area, dom, obs, lat, lon = (F.col(c) for c in ("polygon_area_m2", "dominant_fraction", "observed_fraction", "lat", "lon"))
    placed = finite(lat) & finite(lon) & lat.between(-90, 90) & lon.between(-180, 180)
    checks += [
        ("invalid_area", ~(finite(area) & (area > 0))), ("area_above_cap", finite(area) & (area > s["cap"] * (1 + 1e-6))),
        ("below_threshold", finite(dom) & (dom < s["threshold"] - 1e-12)), ("dominant_exceeds_observed", finite(dom) & finite(obs) & (dom > obs + 1e-6)),
        ("invalid_coordinates", ~placed), ("centroid_wkt_mismatch", placed & ~wkt_near(F.col("centroid_wkt"), lat, lon)),
        ("invalid_text", F.col("text").isNull()), ("unusable_text", F.col("text").isNotNull() & (word_count(F.col("text")) < s["least"])),
        ("unnormalized_text", F.col("text") != normalise(F.col("text"))), ("text_word_count_mismatch", F.col("text").isNotNull() & ~F.col("text_words").eqNullSafe(word_count(F.col("text")))),
    ]
    if s["assignment"]:
        # recomputed from the place and from the cell; the shares and the seed are those of the release
        unit = unit_hash(F.col("h3_cell"), s.get("seed", SEED))
        checks.append(("h3_cell_mismatch", placed & ~cell_for(lat, lon, s.get("resolution", 5)).eqNullSafe(F.col("h3_cell"))))
        checks.append(("h3_assignment_mismatch", F.col("h3_cell").isNotNull() & ~assign_split(unit, s.get("splits", SPLITS)).eqNullSafe(F.col("split"))))
    if "file_split" in rows.columns:
        checks.append(("file_split_mismatch", ~F.col("file_split").eqNullSafe(F.col("split"))))
    return _codes(rows, checks)


def whole_violations(rows: DataFrame) -> DataFrame:
    """(code, culprit) of what only several rows show together: leaking keys, conflicts, repeated records and texts.

    The text is hashed where it is read; only digests are grouped.
    """
    narrow = materialise(rows.select("polygon_id", "document_id", "h3_cell", "osm_type", "osm_id", "worldcover_code", "lat", "lon", "polygon_area_m2", "split", F.hex(text_hash(F.col("text"))).alias("text_hash")))
    parts = [leaking(narrow, c).select(F.lit(f"{c}_leakage").alias("code"), F.col("key").alias("culprit")) for c in ("polygon_id", "document_id", "h3_cell")]
    parts.append(identity_conflicts(narrow).select(F.lit("object_identity_conflict"), F.concat("osm_type", F.lit(":"), F.col("osm_id").cast("string"))))
    parts.append(inconsistent_polygons(narrow).select(F.lit("inconsistent_polygon"), "polygon_id"))
    records = narrow.groupBy("polygon_id", "text_hash", "worldcover_code").agg(F.count("*").alias("n")).where("n > 1")
    parts.append(records.select(F.lit("duplicate_polygon_text_label_record"), F.concat_ws(":", "polygon_id", "text_hash", F.col("worldcover_code").cast("string"))))
    texts = narrow.groupBy("text_hash").agg(F.countDistinct("worldcover_code").alias("labels"), F.countDistinct("split").alias("splits"))
    parts.append(texts.where("splits > 1").select(F.lit("identical_text_cross_split"), "text_hash"))
    parts.append(texts.where("labels > 1").select(F.lit("identical_text_conflicting_labels"), "text_hash"))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def wkt_near(wkt: Column, lat: Column, lon: Column, within: float = 5.1e-8) -> Column:
    """Whether a point text is within a tolerance of a place."""
    pattern = r"^POINT\s*\(\s*([-+0-9.eE]+)\s+([-+0-9.eE]+)\s*\)$"
    x, y = (F.regexp_extract(wkt, pattern, k).try_cast("double") for k in (1, 2))
    return F.coalesce((F.abs(x - lon) <= within) & (F.abs(y - lat) <= within), F.lit(False))


def leaking(rows: DataFrame, column: str) -> DataFrame:
    """(key, splits): keys that stand in several splits; rows without a key have the null key, which leaks like any other."""
    by = rows.groupBy(F.col(column).alias("key")).agg(F.countDistinct("split").alias("splits"))
    return by.where("splits > 1")


def leakage(rows: DataFrame, columns: tuple[str, ...] = ("polygon_id", "document_id", "h3_cell")) -> DataFrame:
    """(key_kind, key, splits) over several key columns."""
    out = None
    for c in columns:
        one = leaking(rows, c).select(F.lit(c).alias("key_kind"), "key", "splits")
        out = one if out is None else out.unionByName(one)
    return out


def identity_conflicts(rows: DataFrame) -> DataFrame:
    """Objects that have several polygon ids; a null id names an object like any other value."""
    by = rows.groupBy("osm_type", "osm_id").agg(F.countDistinct("polygon_id").alias("polygons"))
    return by.where("polygons > 1")


def inconsistent_polygons(rows: DataFrame, columns: tuple[str, ...] = ("worldcover_code", "lat", "lon", "polygon_area_m2", "h3_cell")) -> DataFrame:
    """Polygons whose rows differ in any of the columns; nulls are values here."""
    return rows.groupBy("polygon_id").agg(F.countDistinct(F.struct(*columns)).alias("variants")).where("variants > 1")


def duplicate_records(rows: DataFrame) -> DataFrame:
    """(polygon_id, text_hash, worldcover_code, n) of records that occur again."""
    keyed = rows.select("polygon_id", F.hex(text_hash(F.col("text"))).alias("text_hash"), "worldcover_code")
    return keyed.groupBy("polygon_id", "text_hash", "worldcover_code").agg(F.count("*").alias("n")).where("n > 1")


def text_conflicts(rows: DataFrame) -> DataFrame:
    """(text_hash, labels, splits): equal texts under several labels or in several splits."""
    keyed = rows.select(F.hex(text_hash(F.col("text"))).alias("text_hash"), "worldcover_code", "split")
    by = keyed.groupBy("text_hash").agg(F.countDistinct("worldcover_code").alias("labels"), F.countDistinct("split").alias("splits"))
    return by.where("labels > 1 or splits > 1")


def coordinate_checks(rows: DataFrame) -> DataFrame:
    """(missing_ids, invalid_places) as counts."""
    lat, lon = F.col("lat"), F.col("lon")
    bad = ~(finite(lat) & finite(lon) & lat.between(-90, 90) & lon.between(-180, 180))
    return rows.agg(F.count_if(F.col("polygon_id").isNull() | (F.col("polygon_id") == "")).alias("missing_ids"), F.count_if(F.coalesce(bad, F.lit(True))).alias("invalid_places"))
