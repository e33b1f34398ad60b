"""Schemas of the canonical tables and the fixed values of the land-cover domain."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"s": T.StringType(), "l": T.LongType(), "d": T.DoubleType()}


def _struct(text: str) -> T.StructType:
    return T.StructType([T.StructField(n, _KINDS[k]) for n, k in (x.split(":") for x in text.split())])


POLYGONS = _struct("polygon_id:s region:s osm_type:s osm_id:l wikidata:s name:s lat:d lon:d geometry:s area_m2:d source_pbf:s")
LINKS = _struct("polygon_id:s document_id:s project:s language:s link_sources:s")
DOCUMENTS = _struct("document_id:s language:s title:s url:s lead_text:s full_text:s article_length_words:l fetch_status:s license:s project:s")
EXAMPLES = _struct(
    "polygon_id:s osm_type:s osm_id:l region:s name:s wikidata:s document_id:s project:s language:s title:s url:s text:s lead_text:s text_words:l "
    "worldcover_code:l worldcover_label:s dominant_fraction:d observed_fraction:d lat:d lon:d centroid_wkt:s polygon_area_m2:d source_pbf:s"
)
RELEASE = T.StructType(EXAMPLES.fields + _struct("h3_cell:s split:s dataset_version:s source_dataset:s source_revision:s worldcover_version:s worldcover_year:l").fields)
NULLABLE = frozenset("name wikidata language title url lead_text".split())

# Land-cover classes.
CLASSES = {
    10: "Tree cover", 20: "Shrubland", 30: "Grassland", 40: "Cropland", 50: "Built-up", 60: "Bare / sparse vegetation",
    70: "Snow and ice", 80: "Permanent water bodies", 90: "Herbaceous wetland", 95: "Mangroves", 100: "Moss and lichen",
}
THRESHOLD = 0.8
OVERSHOOT = 0.01
AREA_CAP_M2 = 1e10
MIN_WORDS = 10
SEED = 20180101
SPLITS = (("train", 0.8), ("validation", 0.1), ("test", 0.1))
TILE_DEGREES = 3
