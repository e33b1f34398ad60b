"""Labelled polygons joined to their texts, with an exact account of what every stage loses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions.grid import tile_name, tiles_for_bbox
from ..functions.text import normalise, word_count
from ..schema import EXAMPLES, MIN_WORDS
from .labels import known_label

STAGES = ("no_source_document", "missing_document", "document_fetch_failed", "empty_text", "text_too_short")


def _regional(left: DataFrame, right: DataFrame) -> list[str]:
    """The region file as a further key, where both sides know it: regions are joined each by itself."""
    return ["stem"] if "stem" in left.columns and "stem" in right.columns else []


def join_links(labelled: DataFrame, links: DataFrame, null_safe: bool = False) -> DataFrame:
    """Polygons with each of their links; null ids meet only where `null_safe` is asked for. Region files stay apart where both sides have them."""
    right = links.select(F.col("polygon_id").alias("_p"), "document_id", *[F.col(c).alias(f"_{c}") for c in _regional(labelled, links)])
    on = labelled["polygon_id"].eqNullSafe(right["_p"]) if null_safe else labelled["polygon_id"] == right["_p"]
    if "_stem" in right.columns:
        on = on & (labelled["stem"] == right["_stem"])
    return labelled.join(right, on).drop("_p", "_stem")


def join_documents(linked: DataFrame, documents: DataFrame) -> DataFrame:
    """Links with their documents; columns that both sides have get the ending `_doc`. Region files stay apart where both sides have them."""
    keys = ["document_id", *_regional(linked, documents)]
    clash = {c: f"{c}_doc" for c in documents.columns if c in linked.columns and c not in keys}
    return linked.join(documents.withColumnsRenamed(clash), keys)


def staged(labelled: DataFrame, links: DataFrame, documents: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """Every polygon-link-document combination with the stage it reaches: 0 no link ... 5 usable.

    One pass of outer joins: the loss of every stage then is a count over polygons of the furthest stage reached.
    """
    own = _regional(labelled, links)
    right = links.select("polygon_id", "document_id", *own)
    rows = labelled.join(right, ["polygon_id", *own], "left")
    # A text is counted where it is read: only its number of words goes through the joins.
    docs = documents.select(
        F.col("document_id").alias("_d"), F.col("fetch_status").alias("_status"), F.coalesce(word_count(F.col("full_text")), F.lit(0)).alias("_words"), *[F.col(c).alias(f"_{c}") for c in _regional(rows, documents)]
    )
    on = F.col("document_id") == F.col("_d")
    rows = rows.join(docs, on & (F.col("stem") == F.col("_stem")) if "_stem" in docs.columns else on, "left").drop("_stem")
    stage = (
        F.when(F.col("document_id").isNull(), 0).when(F.col("_d").isNull(), 1).when(~F.coalesce(F.col("_status") == "ok", F.lit(False)), 2)
        .when(F.col("_words") == 0, 3).when(F.col("_words") < least, 4).otherwise(5)
    )
    return rows.withColumn("stage", stage)


def text_losses(rows: DataFrame) -> DataFrame:
    """(reason, n): polygons whose last candidate is lost at each stage."""
    best = rows.groupBy("polygon_id").agg(F.max("stage").alias("stage")).where("stage < 5")
    return best.groupBy(F.get(F.array(*map(F.lit, STAGES)), F.col("stage")).alias("reason")).agg(F.count("*").alias("n"))


def centroid_wkt(lat: Column, lon: Column) -> Column:
    """`POINT (lon lat)` with at most seven decimals and no trailing zeros."""
    number = lambda v: F.regexp_replace(F.regexp_replace(F.format_string("%.7f", v), r"0+$", ""), r"\.$", "")
    plain = lambda v: F.when(number(v) == "-0", F.lit("0")).otherwise(number(v))
    return F.concat(F.lit("POINT ("), plain(lon), F.lit(" "), plain(lat), F.lit(")"))


def project_schema(df: DataFrame, fields=EXAMPLES.fields) -> DataFrame:
    """The published columns in order; absent ones are null."""
    have = set(df.columns)
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def shape(rows: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Derived columns of examples, projected to the published schema and the columns named in `extra`."""
    language = F.col("language_doc") if "language_doc" in rows.columns else F.col("language") if "language" in rows.columns else F.lit(None)
    return project_schema(rows.withColumns({
        "worldcover_label": known_label(F.col("worldcover_code")), "text_words": word_count(F.col("text")), "polygon_area_m2": F.col("area_m2"),
        "centroid_wkt": centroid_wkt(F.col("lat"), F.col("lon")), "language": language.cast("string"),
    }), [*EXAMPLES.fields, *(rows.schema[c] for c in extra)])


def to_examples(labelled: DataFrame, links: DataFrame, documents: DataFrame, least: int = MIN_WORDS, extra: tuple[str, ...] = ()) -> DataFrame:
    """Labelled polygons with their usable texts, shaped."""
    rows = join_documents(join_links(labelled, links), documents).where("fetch_status = 'ok'")
    rows = rows.withColumn("text", normalise(F.coalesce(F.col("full_text"), F.lit(""))))
    return shape(rows.where((F.col("text") != "") & (word_count(F.col("text")) >= least)), extra)


def missing_tiles(polygons: DataFrame, grids: DataFrame, key: str = "region") -> DataFrame:
    """(key, tile): tiles that usable polygons of a region touch and that are not published."""
    m = geo.measures(polygons.where("polygon_id is not null").select("polygon_id", "geometry").dropDuplicates(["polygon_id"])).where("usable")
    touched = m.withColumn("t", F.explode(tiles_for_bbox(F.col("west"), F.col("south"), F.col("east"), F.col("north")))).select("polygon_id", tile_name(F.col("t.lat"), F.col("t.lon")).alias("tile"))
    return polygons.select("polygon_id", key).distinct().join(touched, "polygon_id").select(key, "tile").distinct().join(grids.select("tile"), "tile", "left_anti").select(key, "tile")


def _reasons(rows: DataFrame, key: str, name: str) -> DataFrame:
    """(key, map of counts by reason); a region has a handful of reasons."""
    by = rows.groupBy(key, "reason").agg(F.count("*").alias("n"))
    return by.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias(name))


def region_outcomes(polygons: DataFrame, verdicts: DataFrame, rows: DataFrame, key: str = "region", tiles: DataFrame | None = None) -> DataFrame:
    """One row per region, with the two maps of reasons and the missing tiles: every polygon is in exactly one count.

    polygons_seen = polygons_invalid + polygons_accepted + the rejections, and polygons_accepted = polygons_with_examples +
    the text rejections. Rows of one polygon id are one polygon, `polygons_repeated` says how many more rows there were.
    Counts of links and documents are of the accepted polygons.
    """
    of = polygons.where("polygon_id is not null").groupBy("polygon_id").agg(F.min(key).alias(key))
    judged = verdicts.join(of, "polygon_id")
    one = lambda c: F.sum(c.cast("long"))
    seen = polygons.groupBy(key).agg(F.count("*").alias("_rows"))
    counts = judged.groupBy(key).agg(F.count("*").alias("polygons_seen"), one(F.col("reason").eqNullSafe("invalid")).alias("polygons_invalid"), one(F.col("accepted")).alias("polygons_accepted"))
    refused = _reasons(judged.where("reason is not null AND reason <> 'invalid'"), key, "rejections")
    best = rows.groupBy(key, "polygon_id").agg(
        F.max("stage").alias("stage"), one(F.col("stage") == 5).alias("examples"), F.count("document_id").alias("links"), F.countDistinct(F.when(F.col("stage") >= 2, F.col("document_id"))).alias("documents")
    )
    lost = _reasons(best.where("stage < 5").withColumn("reason", F.get(F.array(*map(F.lit, STAGES)), F.col("stage"))), key, "text_rejections")
    kept = best.groupBy(key).agg(one(F.col("stage") == 5).alias("polygons_with_examples"), F.sum("examples").alias("examples"), F.sum("links").alias("source_links"), F.sum("documents").alias("source_documents"))
    out = seen
    for part in (counts, refused, kept, lost):
        out = out.join(part, key, "left")
    if tiles is not None:
        out = out.join(tiles.groupBy(key).agg(F.array_sort(F.collect_set("tile")).alias("tiles_missing")), key, "left")
    empty = F.create_map().cast("map<string,bigint>")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("polygons_seen", "polygons_invalid", "polygons_accepted", "polygons_with_examples", "source_links", "source_documents", "examples")}
    none = F.array().cast("array<string>")
    out = out.withColumns({**zero, **{c: F.coalesce(F.col(c), empty) for c in ("rejections", "text_rejections")}, "tiles_missing": F.coalesce("tiles_missing", none) if tiles is not None else none})
    return out.withColumn("polygons_repeated", F.col("_rows") - F.col("polygons_seen")).drop("_rows")
