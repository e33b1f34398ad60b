"""Source layouts: three of them, read into canonical polygons, links and documents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as geo
from ..functions.text import text_hash, usable_text
from ..schema import DOCUMENTS, LINKS, POLYGONS


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def stems(spark: SparkSession, root: str) -> list[str]:
    """Sorted names of the Parquet files (or folders) of a table folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    return sorted(n.removesuffix(".parquet") for n in names if n.endswith(".parquet") and not n.startswith(("_", ".")))


def read_tolerant(spark: SparkSession, paths: list[str] | str, schema: T.StructType) -> DataFrame:
    """The columns of a schema in its order: absent files give no rows, absent columns are null, others are not read."""
    found = [p for p in ([paths] if isinstance(paths, str) else paths) if exists(spark, p)]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def read_glob(spark: SparkSession, pattern: str, schema: T.StructType | None = None) -> DataFrame:
    """All Parquet files that a pattern names, as one table; no rows where none does and a schema is given."""
    if schema is None:
        return spark.read.parquet(pattern)
    return read_tolerant(spark, [pattern], schema)


def read_union(spark: SparkSession, paths: list[str], schema: T.StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """Listed files under each other, columns matched by name and cast to the schema; rows with a null in `required` stay out.

    Each file is read by its own schema, so files may differ in types and order; an absent column is null.
    """
    out = None
    for path in paths:
        one = conform(spark.read.parquet(path), schema)
        out = one if out is None else out.unionByName(one)
    out = spark.createDataFrame([], schema) if out is None else out
    return out.dropna(subset=list(required)) if required else out


def register_views(rows: DataFrame) -> None:
    """The release and its text digests as views `release` and `hashes` of the session, for questions in SQL."""
    rows.createOrReplaceTempView("release")
    rows.select(text_hash(F.col("text")).alias("text_hash"), "worldcover_code", "split", "polygon_id").createOrReplaceTempView("hashes")


def stem_of_file() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.parquet(?:/[^/]*)?$", 1)


def region_from_stem(stem: Column) -> Column:
    return F.regexp_replace(stem, "-latest$", "")


def polygon_id(stem: Column, osm_type: Column, osm_id: Column) -> Column:
    """`stem:type/id`; null where a part is."""
    return F.concat(stem, F.lit(":"), osm_type, F.lit("/"), osm_id.cast("string"))


def union_projects(tables: dict[str, DataFrame]) -> DataFrame:
    """Document tables of several corpora under each other, named by their corpus."""
    out = None
    for name, df in tables.items():
        one = df.withColumn("project", F.lit(name))
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def tag_key(key: Column) -> Column:
    return F.when(key.startswith("description:"), key).otherwise(F.concat(F.lit("description:"), key))


def language_suffix(tag: Column) -> Column:
    """What follows `description:`; null for the bare tag and an empty rest."""
    rest = F.regexp_replace(tag, "^description:?", "")
    return F.when((tag != "description") & (rest != ""), rest)


def description_documents(raw: DataFrame, stem: Column) -> tuple[DataFrame, DataFrame]:
    """(links, documents): base and localized descriptions as rows, blank ones dropped."""
    base = F.array(F.struct(F.lit("description").alias("key"), F.col("description").alias("value")))
    more = F.filter(F.coalesce("localized_descriptions", F.array().cast("array<struct<key:string,value:string>>")), lambda x: x["key"].isNotNull())
    more = F.transform(more, lambda x: F.struct(tag_key(x["key"]).alias("key"), x["value"].alias("value")))
    rows = raw.select(polygon_id(stem, F.col("osm_type"), F.col("osm_id")).alias("polygon_id"), "name", "osm_url", F.explode(F.concat(base, more)).alias("x"))
    rows = rows.withColumn("full_text", usable_text(F.col("x.value"))).where("full_text is not null")
    rows = rows.withColumns({"document_id": F.concat("polygon_id", F.lit(":"), F.col("x.key")), "language": language_suffix(F.col("x.key")), "project": F.lit("description")})
    links = rows.select("polygon_id", "document_id", "project", "language", F.lit("[]").alias("link_sources"))
    docs = rows.select("document_id", "language", F.col("name").alias("title"), F.col("osm_url").alias("url"), F.lit("ok").alias("fetch_status"), F.lit("ODbL").alias("license"), "full_text", "project")
    return conform(links, LINKS), conform(docs, DOCUMENTS)


def description_polygons(raw: DataFrame, stem: Column) -> DataFrame:
    """Canonical polygons of a layout whose geometry is binary; centroid and GeoJSON come from one pass over it."""
    rows = raw.select(
        polygon_id(stem, F.col("osm_type"), F.col("osm_id")).alias("polygon_id"), region_from_stem(stem).alias("region"), "osm_type", F.col("osm_id").cast("long").alias("osm_id"),
        "name", "area_m2", "source_pbf", "geometry",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import json

        for b in batches:
            lat, lon, text = [], [], []
            for g in b.column("geometry").to_pylist():
                rings = geo.from_wkb(g)
                c = geo.centroid(rings) if rings else None
                lon.append(c[0] if c else None)
                lat.append(c[1] if c else None)
                text.append(json.dumps({"type": "MultiPolygon", "coordinates": [[r.tolist() for r in p] for p in rings]}) if rings else None)
            keep = [n for n in b.schema.names if n != "geometry"]
            yield pa.record_batch([*[b.column(n) for n in keep], pa.array(lat, pa.float64()), pa.array(lon, pa.float64()), pa.array(text, pa.string())], [*keep, "lat", "lon", "geometry"])

    out = rows.mapInArrow(run, "polygon_id string, region string, osm_type string, osm_id long, name string, area_m2 double, source_pbf string, lat double, lon double, geometry string")
    return conform(out, POLYGONS)


WEBSITE_TEXTS = ("website", "contact_website")


def website_documents(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links, documents): the two text columns of a row as rows of their own, where fetched and not blank."""
    parts = F.array(*[F.struct(F.lit(p).alias("project"), F.col(p).alias("url"), F.col(f"{p}_text").alias("text"), F.col(f"{p}_text_status").alias("status"), F.col(f"{p}_language").alias("language")) for p in WEBSITE_TEXTS])
    rows = raw.select("polygon_id", "name", F.explode(parts).alias("x")).select("polygon_id", "name", "x.*").where("status = 'success'")
    rows = rows.withColumns({"full_text": usable_text(F.col("text")), "document_id": F.concat("polygon_id", F.lit(":"), "project")}).where("full_text is not null")
    links = rows.select("polygon_id", "document_id", "project", "language", F.lit("[]").alias("link_sources"))
    docs = rows.select("document_id", "language", F.col("name").alias("title"), "url", "full_text", F.lit("ok").alias("fetch_status"), "project")
    return conform(links, LINKS), conform(docs, DOCUMENTS)


def website_polygons(raw: DataFrame, stem: Column) -> DataFrame:
    return conform(raw.withColumn("region", F.coalesce("region", region_from_stem(stem))), POLYGONS)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a schema in order and type; absent ones null."""
    have = set(df.columns)
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
