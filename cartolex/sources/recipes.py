"""Source layouts by name: where a region's tables lie, how they are read, and the words a text must have."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DOCUMENTS, LINKS, POLYGONS
from . import readers

DESCRIPTION = T.StructType([
    *[T.StructField(n, T.StringType()) for n in ("source_pbf", "osm_type")], T.StructField("osm_id", T.LongType()), T.StructField("osm_url", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()), T.StructField("localized_descriptions", T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType())]))),
    T.StructField("area_m2", T.DoubleType()), T.StructField("geometry", T.BinaryType()),
])
WEBSITE = T.StructType([
    *[T.StructField(n, T.StringType()) for n in ("polygon_id", "region", "source_pbf", "osm_type")], T.StructField("osm_id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("geometry", T.StringType()),
    *[T.StructField(n, T.DoubleType()) for n in ("lat", "lon", "area_m2")], *[T.StructField(f"{p}{s}", T.StringType()) for p in readers.WEBSITE_TEXTS for s in ("", "_text", "_text_status", "_language")],
])

Triple = tuple[DataFrame, DataFrame, DataFrame]


def _paths(root: str, folder: str, stems: list[str]) -> list[str]:
    return [f"{root.rstrip('/')}/{folder}/{s}.parquet" for s in stems]


def _with_stem(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("stem", T.StringType())])


def _map_links(spark: SparkSession, root: str, stems: list[str]) -> Triple:
    """Polygons, links and the documents of two corpora, each a folder of one file per region.

    A document may stand in the files of several regions; links and documents keep their file, so regions stay apart.
    """
    polygons, links = _stemmed(spark, _paths(root, "polygons", stems), POLYGONS), _stemmed(spark, _paths(root, "polygon_document_links", stems), LINKS)
    plain = T.StructType([f for f in DOCUMENTS.fields if f.name != "project"])
    corpora = {k: _stemmed(spark, _paths(root, f"{k}/documents", stems), plain) for k in ("wikipedia", "wikivoyage")}
    return polygons, links, readers.conform(readers.union_projects(corpora), _with_stem(DOCUMENTS))


def _stemmed(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """A tolerant scan with the region file that each row came from."""
    found = [p for p in paths if readers.exists(spark, p)]
    if not found:
        return spark.createDataFrame([], _with_stem(schema))
    return spark.read.schema(schema).parquet(*found).withColumn("stem", readers.stem_of_file())


def _keyed(raw: DataFrame, polygons: DataFrame) -> DataFrame:
    """Polygons with their region file; a kernel that reads geometry keeps the id, whose first part is the file's name."""
    return polygons.withColumn("stem", F.regexp_extract("polygon_id", r"^(.*):[^:/]*/[^/]*$", 1))


def _descriptions(spark: SparkSession, root: str, stems: list[str]) -> Triple:
    raw = _stemmed(spark, _paths(root, "data", stems), DESCRIPTION)
    return _keyed(raw, readers.description_polygons(raw, F.col("stem"))), *readers.description_documents(raw, F.col("stem"))


def _websites(spark: SparkSession, root: str, stems: list[str]) -> Triple:
    raw = _stemmed(spark, _paths(root, "polygons", stems), WEBSITE)
    named = raw.withColumn("region", F.coalesce("region", readers.region_from_stem(F.col("stem"))))
    polygons = readers.conform(named, _with_stem(POLYGONS))
    return polygons, *readers.website_documents(raw)


@dataclass(frozen=True)
class Recipe:
    """One source: its layout, the folder whose files name its regions, and its defaults."""

    name: str
    inventory: str
    load: Callable[[SparkSession, str, list[str]], Triple]
    least_words: int
    text_description: str
    license: str


RECIPES = {
    r.name: r
    for r in (
        Recipe("wikidata", "polygons", _map_links, 10, "an encyclopedia or travel article", "cc-by-sa-4.0"),
        Recipe("description", "data", _descriptions, 1, "a map object's description", "odbl"),
        Recipe("website", "polygons", _websites, 10, "the text of a place's own website", "other"),
    )
}


def recipe_for(name: str) -> Recipe:
    if name not in RECIPES:
        raise ValueError(f"unknown source {name!r}; known: {sorted(RECIPES)}")
    return RECIPES[name]
