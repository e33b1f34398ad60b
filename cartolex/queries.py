"""Queries over the given tables, one per operator, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import geometry as geo
from .functions import grid, projection, splits, text
from .functions.runtime import read_table
from .operators import checks, dedup, equalarea, examples, labels, ledger, summary, zonal
from .schema import CLASSES, SPLITS
from .sources import readers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


# --- SQL fragments -------------------------------------------------------------------------------------------------

WS = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


class Fragment(str):
    """SQL with a place for one expression; braces of patterns in it stay as they are."""

    def format(self, x: str) -> str:
        return self.replace("{0}", x)


NORM = Fragment("trim(regexp_replace({0}, '" + WS + "', ' ', 'g'), ' ')")
WORDS = Fragment(f"CASE WHEN coalesce({NORM}, '') = '' THEN 0 ELSE len(string_split({NORM}, ' ')) END::BIGINT")
KEY = f"sha256(encode({NORM.format('text')}) || '\\x00'::BLOB || encode(worldcover_code::VARCHAR))"
UNIT = "(('0x' || substr(sha256('20180101:' || {0}), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0::DOUBLE)"
SPLIT = f"CASE WHEN {UNIT} < 0.8::DOUBLE THEN 'train' WHEN {UNIT} < (0.8::DOUBLE + 0.1::DOUBLE) THEN 'validation' ELSE 'test' END"
LABEL = "CASE {0} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in CLASSES.items()) + " END"
CODES = ", ".join(map(str, CLASSES))
HOME = """home AS (
  SELECT r.* FROM release_rows r JOIN (
    SELECT osm_type, osm_id, min(region) AS region FROM release_rows WHERE osm_type IS NOT NULL AND osm_id IS NOT NULL GROUP BY 1, 2
  ) h ON r.osm_type = h.osm_type AND r.osm_id = h.osm_id AND r.region = h.region)"""
OBJECTS = f"""objects AS (
  SELECT *, {KEY} AS dedup_key FROM (
    SELECT *, row_number() OVER (PARTITION BY osm_type, osm_id, document_id ORDER BY polygon_id NULLS LAST, example_id) AS rn FROM home
  ) WHERE rn = 1)"""
EXAMPLES = """examples AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY polygon_id, dedup_key ORDER BY document_id NULLS LAST, example_id) AS rk FROM objects) WHERE rk = 1)"""
KEPT = """kept AS (
  SELECT e.* FROM examples e JOIN (
    SELECT document_id, split FROM (
      SELECT document_id, split, row_number() OVER (PARTITION BY document_id ORDER BY count(*) DESC, split) AS q
      FROM examples WHERE document_id IS NOT NULL GROUP BY document_id, split
    ) WHERE q = 1
  ) b ON e.document_id = b.document_id AND e.split = b.split)"""
WITH_OBJECTS = f"WITH {HOME}, {OBJECTS}"
WITH_EXAMPLES = f"{WITH_OBJECTS}, {EXAMPLES}"
WITH_KEPT = f"{WITH_EXAMPLES}, {KEPT}"
DUPS = """grouped AS (SELECT polygon_id, dedup_key, min(text_words) AS words, count(*) AS n, count(DISTINCT split) AS splits
  FROM objects GROUP BY 1, 2 HAVING count(*) > 1)"""


def _rows(s: SparkSession, d: str) -> DataFrame:
    return read_table(s, d, "release_rows")


def _kept(s: SparkSession, d: str) -> DataFrame:
    return dedup.chain(_rows(s, d))["kept"]


# --- labels --------------------------------------------------------------------------------------------------------

COVER = """cover AS (SELECT l_orderkey AS polygon_id, ((l_partkey % 12) * 10)::INT AS code, sum(l_quantity) AS area FROM lineitem GROUP BY 1, 2),
  wide AS (SELECT *, sum(area) OVER (PARTITION BY polygon_id) AS whole FROM cover)"""
VERDICT = f"""verdict AS (
  SELECT polygon_id, whole, CASE WHEN any_valid THEN fraction ELSE 0.0 END AS fraction, CASE WHEN any_valid THEN code END AS code, observed,
    CASE WHEN NOT (whole > 0) THEN 'empty_polygon' WHEN NOT any_valid THEN 'no_valid_class' WHEN fraction < 0.8::DOUBLE THEN 'below_threshold' END AS reason
  FROM (
    SELECT polygon_id, max(whole) AS whole, sum(area / whole) AS observed, bool_or(code IN ({CODES})) AS any_valid,
      max(area / whole) FILTER (WHERE code IN ({CODES})) AS fraction,
      (list(code ORDER BY area / whole DESC, code) FILTER (WHERE code IN ({CODES})))[1] AS code
    FROM wide GROUP BY 1))"""


def _coverage(s: SparkSession, d: str) -> DataFrame:
    items = read_table(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("polygon_id"), ((F.col("l_partkey") % 12) * 10).cast("int").alias("code"))
    cover = items.agg(F.sum("l_quantity").alias("area"))
    whole = cover.groupBy("polygon_id").agg(F.sum("area").alias("polygon_area"))
    return cover.join(whole, "polygon_id")


@query(f"WITH {COVER}, {VERDICT} SELECT polygon_id, reason IS NULL AS accepted, code, round(fraction, 6) AS fraction, round(observed, 6) AS observed, reason FROM verdict")
def dominance(s: SparkSession, d: str) -> DataFrame:
    v = labels.dominance(_coverage(s, d))
    return v.withColumns({"fraction": F.round("fraction", 6), "observed": F.round("observed", 6)})


@query(f"WITH {COVER}, {VERDICT} SELECT reason, count(*) AS n FROM verdict WHERE reason IS NOT NULL GROUP BY 1")
def rejections(s: SparkSession, d: str) -> DataFrame:
    return labels.rejections(labels.dominance(_coverage(s, d)))


@query(f"SELECT DISTINCT worldcover_code, {LABEL.format('worldcover_code')} AS label FROM release_rows")
def label_lookup(s: SparkSession, d: str) -> DataFrame:
    return _rows(s, d).select("worldcover_code").distinct().withColumn("label", labels.label_for(F.col("worldcover_code")))


@query("SELECT coalesce(area_m2 <= 1e10 AND NOT isnan(area_m2), false) AS within, count(*) AS n FROM polygons GROUP BY 1")
def area_cap(s: SparkSession, d: str) -> DataFrame:
    return read_table(s, d, "polygons").groupBy(labels.within_area_cap(F.col("area_m2")).alias("within")).agg(F.count("*").alias("n"))


# --- text, hashes, splits ------------------------------------------------------------------------------------------


@query(f"SELECT example_id, {NORM.format('text')} AS text_norm FROM release_rows")
def normalise_text(s: SparkSession, d: str) -> DataFrame:
    return summary.normalised_texts(_rows(s, d))


@query(f"SELECT example_id, {WORDS.format('text')} AS words FROM release_rows")
def word_count(s: SparkSession, d: str) -> DataFrame:
    return _rows(s, d).select("example_id", text.word_count(F.col("text")).alias("words"))


@query(f"SELECT example_id, {KEY} AS dedup_key FROM release_rows")
def dedup_key(s: SparkSession, d: str) -> DataFrame:
    return _rows(s, d).select("example_id", text.dedup_key(F.col("text"), F.col("worldcover_code")).alias("dedup_key"))


@query(f"SELECT upper(sha256({NORM.format('text')})) AS text_hash, worldcover_code, split, polygon_id FROM release_rows")
def audit_hashes(s: SparkSession, d: str) -> DataFrame:
    return _rows(s, d).select(F.hex(text.text_hash(F.col("text"))).alias("text_hash"), "worldcover_code", "split", "polygon_id")


@query(f"SELECT DISTINCT h3_cell, {UNIT.format('h3_cell')} AS unit FROM release_rows")
def unit_hash(s: SparkSession, d: str) -> DataFrame:
    return _rows(s, d).select("h3_cell").distinct().withColumn("unit", splits.unit_hash(F.col("h3_cell")))


@query(f"SELECT DISTINCT h3_cell, {SPLIT.format('h3_cell')} AS assigned FROM release_rows")
def assign_split(s: SparkSession, d: str) -> DataFrame:
    return _rows(s, d).select("h3_cell").distinct().withColumn("assigned", splits.assign_split(splits.unit_hash(F.col("h3_cell"))))


@query("""WITH p AS (SELECT polygon_id, lat, lon, least(floor((lat + 90) * (128.0::DOUBLE / 180)), 127) AS r FROM polygons WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180),
  q AS (SELECT *, greatest(1, floor(cos(radians((r + 0.5::DOUBLE) * (180 / 128.0::DOUBLE) - 90)) * 256 + 0.5::DOUBLE)) AS c FROM p)
  SELECT polygon_id, 'b5_' || r::BIGINT || '_' || least(floor((lon + 180) / 360 * c), c - 1)::BIGINT AS cell FROM q
  UNION ALL SELECT polygon_id, NULL FROM polygons WHERE NOT coalesce(lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180, false)""")
def cell_for(s: SparkSession, d: str) -> DataFrame:
    return read_table(s, d, "polygons").select("polygon_id", splits.cell_for(F.col("lat"), F.col("lon")).alias("cell"))


# --- tiles ---------------------------------------------------------------------------------------------------------

TILE = "(floor({0} / 3) * 3)::INT"
TNAME = "(CASE WHEN {0} >= 0 THEN 'N' ELSE 'S' END || lpad(abs({0})::VARCHAR, 2, '0') || CASE WHEN {1} >= 0 THEN 'E' ELSE 'W' END || lpad(abs({1})::VARCHAR, 3, '0'))"
# A polygon's box here: its point with a margin that grows with its area.
BOX = "box AS (SELECT polygon_id, osm_id, least(greatest(sqrt(area_m2) / 100000, 0.0), 4.0) AS m, lat, lon FROM polygons WHERE lat BETWEEN -80 AND 80 AND lon BETWEEN -170 AND 170 AND area_m2 >= 0)"
UPPER = "CASE WHEN floor({0} / 3) * 3 = {0} AND {0} > {1} THEN (floor({0} / 3) * 3 - 3)::INT ELSE (floor({0} / 3) * 3)::INT END"
TILES = f"""tiles AS (SELECT DISTINCT polygon_id, osm_id, tile_lat::INT AS tile_lat, tile_lon::INT AS tile_lon FROM (
  SELECT polygon_id, osm_id, tile_lat, unnest(range({TILE.format('(lon - m)')}, greatest({TILE.format('(lon - m)')}, {UPPER.format('(lon + m)', '(lon - m)')}) + 1, 3)) AS tile_lon FROM (
    SELECT *, unnest(range({TILE.format('(lat - m)')}, greatest({TILE.format('(lat - m)')}, {UPPER.format('(lat + m)', '(lat - m)')}) + 1, 3)) AS tile_lat FROM box)))"""


def _tiles(s: SparkSession, d: str) -> DataFrame:
    p = read_table(s, d, "polygons").where("lat between -80 and 80 and lon between -170 and 170 and area_m2 >= 0")
    m = F.least(F.greatest(F.sqrt("area_m2") / 100000, F.lit(0.0)), F.lit(4.0))
    boxes = grid.tiles_for_bbox(F.col("lon") - m, F.col("lat") - m, F.col("lon") + m, F.col("lat") + m)
    rows = p.select("polygon_id", "osm_id", F.explode(boxes).alias("t"))
    return rows.select("polygon_id", "osm_id", F.col("t.lat").alias("tile_lat"), F.col("t.lon").alias("tile_lon")).distinct()


@query(f"SELECT DISTINCT lat, lon, {TILE.format('lat')} AS tile_lat, {TILE.format('lon')} AS tile_lon FROM polygons WHERE lat IS NOT NULL AND lon IS NOT NULL")
def tile_for(s: SparkSession, d: str) -> DataFrame:
    p = read_table(s, d, "polygons").where("lat is not null and lon is not null").select("lat", "lon").distinct()
    return p.withColumns({"tile_lat": grid.tile_floor(F.col("lat")), "tile_lon": grid.tile_floor(F.col("lon"))})


@query(f"SELECT DISTINCT {TNAME.format(TILE.format('lat'), TILE.format('lon'))} AS tile FROM polygons WHERE lat IS NOT NULL AND lon IS NOT NULL")
def tile_name(s: SparkSession, d: str) -> DataFrame:
    p = read_table(s, d, "polygons").where("lat is not null and lon is not null")
    return p.select(grid.tile_name(grid.tile_floor(F.col("lat")), grid.tile_floor(F.col("lon"))).alias("tile")).distinct()


@query(f"WITH {BOX}, {TILES} SELECT polygon_id, osm_id, tile_lat, tile_lon FROM tiles")
def tile_explode(s: SparkSession, d: str) -> DataFrame:
    return _tiles(s, d)


@query(f"""WITH {BOX}, {TILES}, catalog AS (SELECT DISTINCT {TILE.format('lat')} AS tile_lat, {TILE.format('lon')} AS tile_lon FROM release_rows)
  SELECT {TNAME.format('t.tile_lat', 't.tile_lon')} AS tile, count(*) AS polygons FROM tiles t
  WHERE NOT EXISTS (SELECT 1 FROM catalog c WHERE c.tile_lat = t.tile_lat AND c.tile_lon = t.tile_lon) GROUP BY 1""")
def tile_catalog_miss(s: SparkSession, d: str) -> DataFrame:
    catalog = _rows(s, d).select(grid.tile_floor(F.col("lat")).alias("tile_lat"), grid.tile_floor(F.col("lon")).alias("tile_lon")).distinct()
    gone = grid.missing(_tiles(s, d), catalog)
    return gone.groupBy(grid.tile_name(F.col("tile_lat"), F.col("tile_lon")).alias("tile")).agg(F.count("*").alias("polygons"))


@query("SELECT event_id, event_id // 360 AS r, event_id % 360 AS c, -180 + (event_id % 360 + 0.5::DOUBLE) * 0.25::DOUBLE AS x, 90 - (event_id // 360 + 0.5::DOUBLE) * 0.25::DOUBLE AS y FROM events")
def cell_rowcol(s: SparkSession, d: str) -> DataFrame:
    row, column = grid.cell_place(F.col("event_id"), 360)
    x, y = grid.map_place(row + 0.5, column + 0.5, -180.0, 90.0, 0.25, 0.25)
    return read_table(s, d, "events").select("event_id", row.alias("r"), column.alias("c"), x.alias("x"), y.alias("y"))


@query(f"""SELECT DISTINCT {TNAME.format(TILE.format('lat'), TILE.format('lon'))} AS tile, {TILE.format('lon')}::DOUBLE AS west, ({TILE.format('lat')} + 3)::DOUBLE AS north,
  'v200/2021/map/ESA_WorldCover_10m_2021_v200_' || {TNAME.format(TILE.format('lat'), TILE.format('lon'))} || '_Map.tif' AS file FROM polygons WHERE lat IS NOT NULL AND lon IS NOT NULL""")
def tile_bounds(s: SparkSession, d: str) -> DataFrame:
    p = read_table(s, d, "polygons").where("lat is not null and lon is not null").select(grid.tile_floor(F.col("lat")).alias("a"), grid.tile_floor(F.col("lon")).alias("b")).distinct()
    b = grid.tile_bounds(F.col("a"), F.col("b"))
    return p.select(grid.tile_name(F.col("a"), F.col("b")).alias("tile"), b["west"].alias("west"), b["north"].alias("north"), grid.tile_file(F.col("a"), F.col("b")).alias("file"))


# --- joins and the text funnel -------------------------------------------------------------------------------------

DOCS = """docs AS (SELECT document_id, lang AS "language", title, url, text AS full_text, article_length_words, fetch_status, license, source AS project FROM documents)"""
LAB = "lab AS (SELECT DISTINCT polygon_id, region FROM polygons WHERE coalesce(area_m2 <= 1e10, false))"


def _docs(s: SparkSession, d: str) -> DataFrame:
    t = read_table(s, d, "documents")
    return t.select("document_id", F.col("lang").alias("language"), "title", "url", F.col("text").alias("full_text"), "article_length_words", "fetch_status", "license", F.col("source").alias("project"))


def _labelled(s: SparkSession, d: str) -> DataFrame:
    p = read_table(s, d, "polygons").where(labels.within_area_cap(F.col("area_m2")))
    return p.select("polygon_id", "region").distinct()


@query(f"WITH {LAB} SELECT lab.polygon_id, lab.region, l.document_id FROM lab JOIN links l ON lab.polygon_id = l.polygon_id")
def join_links(s: SparkSession, d: str) -> DataFrame:
    return examples.join_links(_labelled(s, d), read_table(s, d, "links"))


@query(f"WITH {LAB}, {DOCS} SELECT lab.polygon_id, lab.region, l.document_id, docs.title, docs.fetch_status FROM lab JOIN links l ON lab.polygon_id = l.polygon_id JOIN docs ON docs.document_id = l.document_id")
def join_documents(s: SparkSession, d: str) -> DataFrame:
    j = examples.join_documents(examples.join_links(_labelled(s, d), read_table(s, d, "links")), _docs(s, d))
    return j.select("polygon_id", "region", "document_id", "title", "fetch_status")


STAGED = f"""staged AS (SELECT lab.polygon_id, lab.region, CASE WHEN l.document_id IS NULL THEN 0 WHEN docs.document_id IS NULL THEN 1 WHEN coalesce(docs.fetch_status, '') <> 'ok' THEN 2
    WHEN coalesce({NORM.format('docs.full_text')}, '') = '' THEN 3 WHEN {WORDS.format('docs.full_text')} < 10 THEN 4 ELSE 5 END AS stage
  FROM lab LEFT JOIN links l ON lab.polygon_id = l.polygon_id LEFT JOIN docs ON docs.document_id = l.document_id)"""


@query(f"""WITH {LAB}, {DOCS}, {STAGED}, best AS (SELECT polygon_id, max(stage) AS stage FROM staged GROUP BY 1)
  SELECT ['no_source_document', 'missing_document', 'document_fetch_failed', 'empty_text', 'text_too_short'][stage + 1] AS reason, count(*) AS n FROM best WHERE stage < 5 GROUP BY 1""")
def text_funnel(s: SparkSession, d: str) -> DataFrame:
    return examples.text_losses(examples.staged(_labelled(s, d), read_table(s, d, "links"), _docs(s, d)))


# Polygons by id, each judged by its area cap and, in `ledger_reconcile`, by its geometry.
ONE = "one AS (SELECT polygon_id, min(region) AS region, bool_or(coalesce(area_m2 <= 1e10 AND NOT isnan(area_m2), false)) AS ok FROM polygons WHERE polygon_id IS NOT NULL AND region IS NOT NULL GROUP BY 1)"
OF = """staged AS (SELECT one.region, one.polygon_id, l.document_id, docs.document_id AS found, CASE WHEN l.document_id IS NULL THEN 0 WHEN docs.document_id IS NULL THEN 1 WHEN coalesce(docs.fetch_status, '') <> 'ok' THEN 2
    WHEN {w} = 0 THEN 3 WHEN {w} < 10 THEN 4 ELSE 5 END AS stage
  FROM one LEFT JOIN links l ON one.polygon_id = l.polygon_id LEFT JOIN docs ON docs.document_id = l.document_id WHERE one.ok)""".replace("{w}", WORDS.format("docs.full_text"))


def _outcomes(s: SparkSession, d: str, geometry: bool = False) -> DataFrame:
    p = read_table(s, d, "polygons").where("polygon_id is not null and region is not null")
    one = p.groupBy("polygon_id").agg(F.min("region").alias("region"), F.bool_or(labels.within_area_cap(F.col("area_m2"))).alias("ok"))
    reason = F.when(~F.col("ok"), "too_large")
    if geometry:
        usable = geo.measures(p.select("polygon_id", "geometry")).groupBy("polygon_id").agg(F.bool_or("usable").alias("usable"))
        one, reason = one.join(usable, "polygon_id"), F.when(~F.col("usable"), "invalid").when(~F.col("ok"), "too_large")
    verdicts = one.select("polygon_id", "region", reason.alias("reason")).withColumn("accepted", F.col("reason").isNull())
    rows = examples.staged(verdicts.where("accepted").select("polygon_id", "region"), read_table(s, d, "links"), _docs(s, d))
    return examples.region_outcomes(p, verdicts.drop("region"), rows)


@query(f"""WITH {ONE}, {DOCS}, {OF}, best AS (SELECT region, polygon_id, max(stage) AS stage, count(*) FILTER (WHERE stage = 5) AS examples, count(document_id) AS links, count(DISTINCT found) AS documents FROM staged GROUP BY 1, 2),
  a AS (SELECT region, count(*) AS polygons_seen, count(*) FILTER (WHERE ok) AS polygons_accepted, count(*) FILTER (WHERE NOT ok) AS too_large FROM one GROUP BY 1),
  r AS (SELECT region, count(*) AS n FROM polygons WHERE polygon_id IS NOT NULL AND region IS NOT NULL GROUP BY 1),
  b AS (SELECT region, count(*) FILTER (WHERE stage = 5) AS polygons_with_examples, count(*) FILTER (WHERE stage < 5) AS lost, count(*) FILTER (WHERE stage = 4) AS text_too_short, sum(examples)::BIGINT AS examples, sum(links)::BIGINT AS links, sum(documents)::BIGINT AS documents FROM best GROUP BY 1)
  SELECT r.region, coalesce(polygons_seen, 0) AS polygons_seen, coalesce(polygons_accepted, 0) AS polygons_accepted, coalesce(polygons_with_examples, 0) AS polygons_with_examples, coalesce(examples, 0) AS examples, coalesce(too_large, 0) AS too_large,
    coalesce(lost, 0) AS lost, coalesce(text_too_short, 0) AS text_too_short, coalesce(links, 0) AS source_links, coalesce(documents, 0) AS source_documents, n - coalesce(polygons_seen, 0) AS polygons_repeated
  FROM r LEFT JOIN a ON r.region = a.region LEFT JOIN b ON r.region = b.region""")
def region_outcome(s: SparkSession, d: str) -> DataFrame:
    of = lambda m, k: F.coalesce(F.try_element_at(m, F.lit(k)), F.lit(0).cast("long")).alias(k)
    lost = F.aggregate(F.map_values("text_rejections"), F.lit(0).cast("long"), lambda a, b: a + b)
    return _outcomes(s, d).select(
        "region", "polygons_seen", "polygons_accepted", "polygons_with_examples", "examples", of("rejections", "too_large"), lost.alias("lost"), of("text_rejections", "text_too_short"), "source_links", "source_documents", "polygons_repeated"
    )


@query(f"""WITH {ONE}, {DOCS}, {OF}, best AS (SELECT polygon_id, max(stage) AS stage, count(*) FILTER (WHERE stage = 5) AS n, count(document_id) AS links FROM staged GROUP BY 1),
  m AS (SELECT ['no_source_document', 'missing_document', 'document_fetch_failed', 'empty_text', 'text_too_short'][stage + 1] AS reason, count(*) AS k FROM best WHERE stage < 5 GROUP BY 1)
  SELECT (SELECT count(*) FROM one) AS polygons_seen, (SELECT count(*) FROM one WHERE ok) AS polygons_accepted, (SELECT sum(n)::BIGINT FROM best) AS examples, (SELECT sum(links)::BIGINT FROM best) AS source_links,
    (SELECT count(*) FROM one WHERE NOT ok) AS too_large, (SELECT string_agg(reason || '=' || k, ',' ORDER BY reason) FROM m) AS lost""")
def outcome_totals(s: SparkSession, d: str) -> DataFrame:
    """The totals of all regions' outcomes: column sums and maps merged by reason."""
    t = ledger.totals(_outcomes(s, d), ("polygons_seen", "polygons_accepted", "examples", "source_links"))
    lost = F.concat_ws(",", F.transform(F.array_sort(F.map_entries("text_rejections")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))))
    return t.select("polygons_seen", "polygons_accepted", "examples", "source_links", F.coalesce(F.try_element_at("rejections", F.lit("too_large")), F.lit(0).cast("long")).alias("too_large"), lost.alias("lost"))


@query("""SELECT polygon_id, region, NULL::VARCHAR AS wikidata_label, name, area_m2 FROM polygons""")
def project_schema(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import types as T

    fields = T.StructType([T.StructField(n, T.StringType()) for n in ("polygon_id", "region", "wikidata_label", "name")] + [T.StructField("area_m2", T.DoubleType())])
    return examples.project_schema(read_table(s, d, "polygons"), fields)


WKTN = "CASE WHEN rtrim(rtrim(printf('%.7f', {0}), '0'), '.') = '-0' THEN '0' ELSE rtrim(rtrim(printf('%.7f', {0}), '0'), '.') END"


@query(f"SELECT DISTINCT lat, lon, 'POINT (' || {WKTN.format('lon')} || ' ' || {WKTN.format('lat')} || ')' AS wkt FROM polygons WHERE lat IS NOT NULL AND lon IS NOT NULL")
def centroid_wkt(s: SparkSession, d: str) -> DataFrame:
    p = read_table(s, d, "polygons").where("lat is not null and lon is not null").select("lat", "lon").distinct()
    return p.withColumn("wkt", examples.centroid_wkt(F.col("lat"), F.col("lon")))


@query(f"SELECT example_id, {LABEL.format('worldcover_code')} AS label, {WORDS.format('text')} AS words, polygon_area_m2 AS area_m2 FROM release_rows")
def shape_columns(s: SparkSession, d: str) -> DataFrame:
    return _rows(s, d).select("example_id", labels.label_for(F.col("worldcover_code")).alias("label"), text.word_count(F.col("text")).alias("words"), F.col("polygon_area_m2").alias("area_m2"))


@query("SELECT page_id, regexp_replace(source_pbf, '\\.osm\\.pbf$', '') || ':' || osm_type || '/' || osm_id AS made_id, regexp_replace(regexp_replace(source_pbf, '\\.osm\\.pbf$', ''), '-latest$', '') AS stem_region FROM website")
def make_ids(s: SparkSession, d: str) -> DataFrame:
    stem = F.regexp_replace("source_pbf", r"\.osm\.pbf$", "")
    return read_table(s, d, "website").select("page_id", readers.polygon_id(stem, F.col("osm_type"), F.col("osm_id")).alias("made_id"), readers.region_from_stem(stem).alias("stem_region"))


@query("SELECT page_id, coalesce(region, regexp_replace(regexp_replace(source_pbf, '\\.osm\\.pbf$', ''), '-latest$', '')) AS region FROM website")
def coalesce_region(s: SparkSession, d: str) -> DataFrame:
    stem = F.regexp_replace("source_pbf", r"\.osm\.pbf$", "")
    return read_table(s, d, "website").select("page_id", F.coalesce("region", readers.region_from_stem(stem)).alias("region"))


# --- the global pass -----------------------------------------------------------------------------------------------


@query(f"WITH {HOME} SELECT example_id, region FROM home")
def home_region(s: SparkSession, d: str) -> DataFrame:
    return dedup.home_region(_rows(s, d)).select("example_id", "region")


@query(f"{WITH_OBJECTS} SELECT example_id, polygon_id, document_id FROM objects")
def dedup_objects(s: SparkSession, d: str) -> DataFrame:
    return dedup.chain(_rows(s, d))["objects"].select("example_id", "polygon_id", "document_id")


@query(f"{WITH_EXAMPLES} SELECT example_id, polygon_id, dedup_key FROM examples")
def dedup_examples(s: SparkSession, d: str) -> DataFrame:
    return dedup.chain(_rows(s, d))["examples"].select("example_id", "polygon_id", "dedup_key")


@query(f"{WITH_KEPT} SELECT example_id, document_id, split FROM kept")
def document_home(s: SparkSession, d: str) -> DataFrame:
    return _kept(s, d).select("example_id", "document_id", "split")


@query(f"{WITH_KEPT} SELECT 'input' AS step, count(*) AS rows_kept FROM release_rows UNION ALL SELECT 'home', count(*) FROM home UNION ALL SELECT 'objects', count(*) FROM objects UNION ALL SELECT 'examples', count(*) FROM examples UNION ALL SELECT 'kept', count(*) FROM kept")
def dedup_stats(s: SparkSession, d: str) -> DataFrame:
    return dedup.stats(_rows(s, d))


@query(f"""{WITH_OBJECTS}, {DUPS} SELECT count(*) AS dup_groups, coalesce(sum(n - 1), 0)::BIGINT AS removed, count(*) FILTER (WHERE splits > 1) AS cross_groups,
  coalesce(sum(n - 1) FILTER (WHERE splits > 1), 0)::BIGINT AS cross_removed FROM grouped""")
def dup_analysis(s: SparkSession, d: str) -> DataFrame:
    return dedup.duplicate_summary(dedup.chain(_rows(s, d))["objects"])


@query(f"""{WITH_OBJECTS}, {DUPS}, b AS (SELECT CASE WHEN words < 10 THEN words::VARCHAR ELSE '10+' END AS words, sum(n - 1)::BIGINT AS removed FROM grouped GROUP BY 1),
  names AS (SELECT unnest(['1','2','3','4','5','6','7','8','9','10+']) AS words) SELECT names.words, coalesce(removed, 0) AS removed FROM names LEFT JOIN b ON names.words = b.words""")
def dup_by_words(s: SparkSession, d: str) -> DataFrame:
    return dedup.duplicates_by_words(dedup.chain(_rows(s, d))["objects"])


GROUPS = """SELECT '{0}' AS key_kind, count(*) AS n_groups, coalesce(sum(n), 0)::BIGINT AS n_rows, count(*) FILTER (WHERE splits > 1) AS cross_groups, coalesce(sum(n) FILTER (WHERE splits > 1), 0)::BIGINT AS cross_rows
  FROM (SELECT {1} AS k, count(*) AS n, count(DISTINCT split) AS splits FROM kept GROUP BY 1 HAVING count(*) > 1)"""


@query(f"{WITH_KEPT} {GROUPS.format('text_label', 'dedup_key')} UNION ALL {GROUPS.format('text', f'sha256({NORM.format(chr(116) + chr(101) + chr(120) + chr(116))})')}")
def retained_text(s: SparkSession, d: str) -> DataFrame:
    return dedup.retained_text(_kept(s, d))


# --- summaries -----------------------------------------------------------------------------------------------------


@query(f"""{WITH_KEPT}, names AS (SELECT unnest(['train', 'validation', 'test']) AS split),
  counts AS (SELECT names.split, count(k.example_id) AS examples, count(DISTINCT k.polygon_id) AS polygons, count(DISTINCT k.document_id) AS documents FROM names LEFT JOIN kept k ON k.split = names.split GROUP BY 1)
  SELECT * FROM counts UNION ALL SELECT 'total', sum(examples)::BIGINT, sum(polygons)::BIGINT, sum(documents)::BIGINT FROM counts""")
def split_counts(s: SparkSession, d: str) -> DataFrame:
    return summary.split_counts(_kept(s, d))


@query(f"{WITH_KEPT} SELECT worldcover_code, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM kept GROUP BY 1")
def class_distribution(s: SparkSession, d: str) -> DataFrame:
    return summary.distribution(_kept(s, d), "worldcover_code")


@query(f'{WITH_KEPT} SELECT "language", count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM kept GROUP BY 1')
def language_distribution(s: SparkSession, d: str) -> DataFrame:
    return summary.distribution(_kept(s, d), "language")


@query(f"""{WITH_KEPT} SELECT "language", n FROM (SELECT "language", count(*) AS n FROM kept GROUP BY 1) ORDER BY n DESC, "language" IS NULL, coalesce("language", '') LIMIT 10""")
def top_languages(s: SparkSession, d: str) -> DataFrame:
    """A report of the ten most frequent languages."""
    by = _kept(s, d).groupBy("language").agg(F.count("*").alias("n"))
    return by.orderBy(*summary.by_frequency(by, "language")).limit(10)


@query(f"{WITH_KEPT} SELECT round(quantile_cont(dominant_fraction, 0.5), 6) AS p50, round(quantile_cont(dominant_fraction, 0.9), 6) AS p90, round(quantile_cont(dominant_fraction, 0.99), 6) AS p99 FROM kept")
def quantiles(s: SparkSession, d: str) -> DataFrame:
    return summary.quantiles(_kept(s, d))


@query(f"{WITH_KEPT} SELECT min(lon) AS west, min(lat) AS south, max(lon) AS east, max(lat) AS north FROM kept WHERE isfinite(lat) AND isfinite(lon)")
def bbox(s: SparkSession, d: str) -> DataFrame:
    return summary.bbox(_kept(s, d))


@query(f"{WITH_KEPT} SELECT count(DISTINCT h3_cell) AS cells, count(DISTINCT region) AS regions FROM kept")
def coverage_stats(s: SparkSession, d: str) -> DataFrame:
    return summary.coverage_stats(_kept(s, d))


@query(f"""{WITH_KEPT} SELECT worldcover_code, trim(name) AS name, worldcover_label FROM kept WHERE name IS NOT NULL AND length(trim(name)) > 0
  QUALIFY row_number() OVER (PARTITION BY worldcover_code ORDER BY lower(trim(name)), polygon_id, document_id, example_id) = 1""")
def top_named(s: SparkSession, d: str) -> DataFrame:
    return summary.top_named(_kept(s, d))


@query(f"{WITH_KEPT} SELECT split, polygon_id, document_id, row_number() OVER (PARTITION BY split ORDER BY polygon_id, document_id, example_id) AS place FROM kept")
def split_ordered(s: SparkSession, d: str) -> DataFrame:
    """Every row with its place in its split's order: ranks over sorted ranges and counts before each range."""
    from .plans.release import ordered_places

    return ordered_places(_kept(s, d), "split", ["polygon_id", "document_id", "example_id"]).select("split", "polygon_id", "document_id", "place")


@query("SELECT polygon_id, min(lat) AS lat, min(lon) AS lon, min(worldcover_code)::INT AS worldcover_code, min(worldcover_label) AS worldcover_label FROM release_rows WHERE worldcover_code IS NOT NULL AND worldcover_label IS NOT NULL GROUP BY 1")
def centroids(s: SparkSession, d: str) -> DataFrame:
    return summary.centroids(_rows(s, d))


@query("SELECT polygon_id FROM release_rows WHERE worldcover_code IS NOT NULL AND worldcover_label IS NOT NULL GROUP BY 1 HAVING count(DISTINCT worldcover_code) > 1 OR count(DISTINCT worldcover_label) > 1 OR count(DISTINCT lat) > 1 OR count(DISTINCT lon) > 1")
def polygon_conflicts(s: SparkSession, d: str) -> DataFrame:
    return summary.polygon_conflicts(_rows(s, d))


# --- checks --------------------------------------------------------------------------------------------------------

LEAK = "SELECT {0} AS key, count(DISTINCT split) AS splits FROM release_rows GROUP BY 1 HAVING count(DISTINCT split) > 1"
VIOLATIONS = f"""v AS (
  SELECT 'invalid_split' AS code, polygon_id AS culprit FROM release_rows WHERE NOT coalesce(split IN ('train', 'validation', 'test'), false)
  UNION ALL SELECT 'invalid_label', polygon_id FROM release_rows WHERE NOT coalesce({LABEL.format('worldcover_code')} = worldcover_label, false)
  UNION ALL SELECT 'invalid_fraction', polygon_id FROM release_rows WHERE NOT coalesce(dominant_fraction BETWEEN 0 AND 1 AND NOT isnan(dominant_fraction), false)
  UNION ALL SELECT 'below_threshold', polygon_id FROM release_rows WHERE dominant_fraction BETWEEN 0 AND 1 AND dominant_fraction < 0.8::DOUBLE
  UNION ALL SELECT 'unusable_text', polygon_id FROM release_rows WHERE {WORDS.format('text')} < 10
  UNION ALL SELECT 'duplicate_example', polygon_id FROM (SELECT polygon_id, {KEY} AS k, row_number() OVER (PARTITION BY polygon_id, {KEY}) AS rn FROM release_rows WHERE worldcover_code IS NOT NULL) WHERE rn > 1
  UNION ALL SELECT 'polygon_leakage', key FROM ({LEAK.format('polygon_id')}) UNION ALL SELECT 'document_leakage', key FROM ({LEAK.format('document_id')}))"""
REPORT = "SELECT code, count(*) AS n, array_to_string(list_sort((list(culprit ORDER BY culprit))[1:5]), '|') AS samples FROM v GROUP BY 1"


def _report(v: DataFrame) -> DataFrame:
    return checks.report(v).withColumn("samples", F.concat_ws("|", "samples"))


@query(f"WITH {VIOLATIONS} {REPORT}")
def validate_rows(s: SparkSession, d: str) -> DataFrame:
    return _report(checks.release_violations(_rows(s, d)))


NEAR = r"coalesce(abs(try_cast(regexp_extract(centroid_wkt, '^POINT\s*\(\s*([-+0-9.eE]+)\s+([-+0-9.eE]+)\s*\)$', 1) AS DOUBLE) - lon) <= 5.1e-8 AND abs(try_cast(regexp_extract(centroid_wkt, '^POINT\s*\(\s*([-+0-9.eE]+)\s+([-+0-9.eE]+)\s*\)$', 2) AS DOUBLE) - lat) <= 5.1e-8, false)"
PLACED = "coalesce(isfinite(lat) AND isfinite(lon) AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180, false)"


def _audit_sql() -> str:
    tests = [(f"required_null:{f.name}", f'"{f.name}" IS NULL') for f in checks.RELEASE.fields if f.name not in checks.NULLABLE]
    tests += [("invalid_split", "NOT coalesce(split IN ('train', 'validation', 'test'), false)"), ("invalid_label", f"{LABEL.format('worldcover_code')} IS DISTINCT FROM worldcover_label"), ("provenance_mismatch:dataset_version", "dataset_version IS DISTINCT FROM '2.0.0'")]
    tests += [(f"empty_identifier:{c}", f"coalesce({NORM.format(c)}, '') = ''") for c in ("polygon_id", "document_id", "region", "source_pbf", "h3_cell")]
    tests += [(f"invalid_fraction:{c}", f"NOT coalesce(isfinite({c}) AND {c} BETWEEN 0 AND 1 + 1e-6, false)") for c in ("dominant_fraction", "observed_fraction")]
    tests += [
        ("invalid_area", "NOT coalesce(isfinite(polygon_area_m2) AND polygon_area_m2 > 0, false)"), ("area_above_cap", "isfinite(polygon_area_m2) AND polygon_area_m2 > 1e10 * (1 + 1e-6)"),
        ("below_threshold", "isfinite(dominant_fraction) AND dominant_fraction < 0.8::DOUBLE - 1e-12"), ("dominant_exceeds_observed", "isfinite(dominant_fraction) AND isfinite(observed_fraction) AND dominant_fraction > observed_fraction + 1e-6"),
        ("invalid_coordinates", f"NOT {PLACED}"), ("centroid_wkt_mismatch", f"{PLACED} AND NOT {NEAR}"), ("invalid_text", "text IS NULL"), ("unusable_text", f"text IS NOT NULL AND {WORDS.format('text')} < 10"),
        ("unnormalized_text", f"text <> {NORM.format('text')}"), ("text_word_count_mismatch", f"text IS NOT NULL AND text_words IS DISTINCT FROM {WORDS.format('text')}"),
    ]
    return "WITH v AS (" + " UNION ALL ".join(f"SELECT '{n}' AS code, polygon_id AS culprit FROM release_rows WHERE {c}" for n, c in tests) + f") {REPORT}"


@query(_audit_sql())
def audit_rows(s: SparkSession, d: str) -> DataFrame:
    return _report(checks.audit_violations(_rows(s, d), {"provenance": {"dataset_version": "2.0.0"}}))


@query("SELECT count(*) FILTER (WHERE polygon_id IS NULL OR polygon_id = '') AS missing_ids, count(*) FILTER (WHERE lat IS NULL OR lon IS NULL OR NOT isfinite(lat) OR NOT isfinite(lon) OR lat < -90 OR lat > 90 OR lon < -180 OR lon > 180) AS invalid_places FROM release_rows")
def coord_checks(s: SparkSession, d: str) -> DataFrame:
    return checks.coordinate_checks(_rows(s, d))


@query("SELECT source_revision, regexp_matches(source_revision, '^[0-9a-f]{40}$') AS pinned, count(*) AS n FROM release_rows GROUP BY 1, 2")
def revision_check(s: SparkSession, d: str) -> DataFrame:
    return _rows(s, d).groupBy("source_revision", checks.is_full_revision(F.col("source_revision")).alias("pinned")).agg(F.count("*").alias("n"))


@query(" UNION ALL ".join(f"SELECT '{c}' AS key_kind, key, splits FROM ({LEAK.format(c)})" for c in ("polygon_id", "document_id", "h3_cell")))
def leakage(s: SparkSession, d: str) -> DataFrame:
    return checks.leakage(_rows(s, d))


@query(f"SELECT key FROM ({LEAK.format('document_id')}) ORDER BY key LIMIT 5")
def leakage_samples(s: SparkSession, d: str) -> DataFrame:
    """A report of the five first offenders."""
    return checks.leaking(_rows(s, d), "document_id").select("key").orderBy("key").limit(5)


@query("SELECT osm_type, osm_id, count(DISTINCT polygon_id) AS polygons FROM release_rows GROUP BY 1, 2 HAVING count(DISTINCT polygon_id) > 1")
def identity_conflict(s: SparkSession, d: str) -> DataFrame:
    return checks.identity_conflicts(_rows(s, d))


@query("SELECT polygon_id, count(*) AS variants FROM (SELECT DISTINCT polygon_id, worldcover_code, lat, lon, polygon_area_m2, h3_cell FROM release_rows) GROUP BY 1 HAVING count(*) > 1")
def inconsistent_polygon(s: SparkSession, d: str) -> DataFrame:
    return checks.inconsistent_polygons(_rows(s, d))


HASH = f"upper(sha256({NORM.format('text')}))"
WHOLE = " UNION ALL ".join((
    *(f"SELECT '{c}_leakage' AS code, key AS culprit FROM ({LEAK.format(c)})" for c in ("polygon_id", "document_id", "h3_cell")),
    "SELECT 'object_identity_conflict', osm_type || ':' || osm_id FROM release_rows GROUP BY osm_type, osm_id HAVING count(DISTINCT polygon_id) > 1",
    "SELECT 'inconsistent_polygon', polygon_id FROM release_rows GROUP BY polygon_id HAVING count(DISTINCT (worldcover_code, lat, lon, polygon_area_m2, h3_cell)) > 1",
    f"SELECT 'duplicate_polygon_text_label_record', concat_ws(':', polygon_id, {HASH}, worldcover_code::VARCHAR) FROM release_rows GROUP BY polygon_id, {HASH}, worldcover_code HAVING count(*) > 1",
    f"SELECT 'identical_text_cross_split', {HASH} FROM release_rows GROUP BY {HASH} HAVING count(DISTINCT split) > 1",
    f"SELECT 'identical_text_conflicting_labels', {HASH} FROM release_rows GROUP BY {HASH} HAVING count(DISTINCT worldcover_code) > 1",
))


@query(f"WITH v AS ({WHOLE}) {REPORT}")
def audit_whole(s: SparkSession, d: str) -> DataFrame:
    """What only several rows show together: leaking keys, conflicts and repeated records or texts."""
    return _report(checks.whole_violations(_rows(s, d)))


@query(f"SELECT polygon_id, upper(sha256({NORM.format('text')})) AS text_hash, worldcover_code, count(*) AS n FROM release_rows GROUP BY 1, 2, 3 HAVING count(*) > 1")
def dup_records(s: SparkSession, d: str) -> DataFrame:
    return checks.duplicate_records(_rows(s, d))


@query(f"SELECT upper(sha256({NORM.format('text')})) AS text_hash, count(DISTINCT worldcover_code) AS labels, count(DISTINCT split) AS splits FROM release_rows GROUP BY 1 HAVING count(DISTINCT worldcover_code) > 1 OR count(DISTINCT split) > 1")
def text_conflicts(s: SparkSession, d: str) -> DataFrame:
    return checks.text_conflicts(_rows(s, d))


# --- ledgers -------------------------------------------------------------------------------------------------------


def _stems(s: SparkSession, d: str, table: str) -> DataFrame:
    return read_table(s, d, table).where("region is not null").select(F.col("region").alias("stem")).distinct()


@query("SELECT DISTINCT region AS stem FROM polygons WHERE region IS NOT NULL AND region NOT IN (SELECT region FROM website WHERE region IS NOT NULL)")
def inventory_gaps(s: SparkSession, d: str) -> DataFrame:
    return ledger.gaps(_stems(s, d, "polygons"), _stems(s, d, "website"))


@query("SELECT region AS stem FROM polygons WHERE region IS NOT NULL INTERSECT SELECT region FROM website WHERE region IS NOT NULL")
def inventory_overlap(s: SparkSession, d: str) -> DataFrame:
    return ledger.overlap(_stems(s, d, "polygons"), _stems(s, d, "website"))


@query("""WITH a AS (SELECT DISTINCT region FROM polygons WHERE region IS NOT NULL), b AS (SELECT DISTINCT region FROM release_rows WHERE region IS NOT NULL),
  c AS (SELECT (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS only_a, (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS only_b)
  SELECT only_a, only_b, only_a = 0 AND only_b = 0 AS same FROM c""")
def inventory_equal(s: SparkSession, d: str) -> DataFrame:
    return ledger.equal(_stems(s, d, "polygons"), _stems(s, d, "release_rows"))


@query("SELECT coalesce(website_text_status, 'null') AS reason, count(*) AS n FROM website GROUP BY 1")
def ledger_totals(s: SparkSession, d: str) -> DataFrame:
    """Maps of counts per region, merged into one."""
    by = read_table(s, d, "website").groupBy("region", F.coalesce("website_text_status", F.lit("null")).alias("k")).agg(F.count("*").alias("n"))
    maps = by.groupBy("region").agg(F.map_from_entries(F.collect_list(F.struct("k", "n"))).alias("counts"))
    return ledger.merge_counts(maps, "counts")


@query("SELECT DISTINCT region, true AS polygons_balance, true AS texts_balance FROM polygons WHERE region IS NOT NULL AND polygon_id IS NOT NULL")
def ledger_reconcile(s: SparkSession, d: str) -> DataFrame:
    """Whether every region's books add up, with polygons refused by geometry, by area and by text: they must."""
    add = lambda m: F.aggregate(F.map_values(m), F.lit(0).cast("long"), lambda a, b: a + b)
    rows = _outcomes(s, d, geometry=True).withColumns({"rejected": add("rejections"), "text_rejected": add("text_rejections")})
    return ledger.reconcile(rows).select("region", "polygons_balance", "texts_balance")


@query("SELECT region AS stem FROM polygons WHERE region IS NOT NULL UNION SELECT region FROM website WHERE region IS NOT NULL")
def inventory_union(s: SparkSession, d: str) -> DataFrame:
    return ledger.union_keys(_stems(s, d, "polygons"), _stems(s, d, "website"))


@query("SELECT dataset_version AS revision, array_to_string(list_sort(list(DISTINCT region)), ',') AS stems FROM release_rows WHERE region IS NOT NULL GROUP BY 1")
def provenance_groups(s: SparkSession, d: str) -> DataFrame:
    rows = _rows(s, d).where("region is not null").select(F.col("dataset_version").alias("revision"), F.col("region").alias("stem"))
    return ledger.provenance_groups(rows).withColumn("stems", F.array_join("stems", ","))


# --- sources -------------------------------------------------------------------------------------------------------

TRIM = Fragment("nullif(regexp_replace({0}, '^" + WS + "|" + WS + "$', '', 'g'), '')")


@query(f"""WITH raw AS (SELECT *, regexp_replace(source_pbf, '\\.osm\\.pbf$', '') || ':' || osm_type || '/' || osm_id AS pid FROM website),
  x AS (SELECT pid, name, unnest([{{'k': 'description', 'v': website_text}}, {{'k': 'description:' || coalesce(nullif(website_language, ''), 'xx'), 'v': contact_website_text}}, {{'k': 'description:', 'v': name}}]) AS e FROM raw)
  SELECT pid AS polygon_id, pid || ':' || e.k AS document_id, CASE WHEN e.k <> 'description' AND e.k <> 'description:' THEN substr(e.k, 13) END AS "language", {TRIM.format('e.v')} AS full_text FROM x WHERE {TRIM.format('e.v')} IS NOT NULL AND pid IS NOT NULL""")
def unnest_localized(s: SparkSession, d: str) -> DataFrame:
    w = read_table(s, d, "website")
    pair = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    lang = F.coalesce(F.when(F.col("website_language") != "", F.col("website_language")), F.lit("xx"))
    raw = w.where("osm_type is not null and osm_id is not null and source_pbf is not null").select(
        "osm_type", "osm_id", "name", "source_pbf", F.col("website").alias("osm_url"), F.col("website_text").alias("description"),
        F.array(pair(lang, F.col("contact_website_text")), pair(F.lit("description:"), F.col("name"))).alias("localized_descriptions"),
    )
    links, docs = readers.description_documents(raw, F.regexp_replace("source_pbf", r"\.osm\.pbf$", ""))
    return docs.select(F.regexp_replace("document_id", ":description(:.*)?$", "").alias("polygon_id"), "document_id", "language", "full_text")


@query(" UNION ALL ".join(f"SELECT polygon_id || ':{p}' AS document_id, {p}_language AS \"language\", {p} AS url, {TRIM.format(f'{p}_text')} AS full_text, '{p}' AS project FROM website WHERE {p}_text_status = 'success' AND {TRIM.format(f'{p}_text')} IS NOT NULL" for p in readers.WEBSITE_TEXTS))
def unpivot_text(s: SparkSession, d: str) -> DataFrame:
    return readers.website_documents(read_table(s, d, "website"))[1].select("document_id", "language", "url", "full_text", "project")


@query("SELECT document_id, title, 'wikipedia' AS project FROM documents WHERE source = 'wikipedia' UNION ALL SELECT document_id, title, 'wikivoyage' FROM documents WHERE source = 'wikivoyage'")
def union_projects(s: SparkSession, d: str) -> DataFrame:
    t = read_table(s, d, "documents").select("document_id", "title", "source")
    return readers.union_projects({k: t.where(F.col("source") == k).drop("source") for k in ("wikipedia", "wikivoyage")})


@query("SELECT polygon_id, document_id FROM links")
def scan_project(s: SparkSession, d: str) -> DataFrame:
    return readers.read_tolerant(s, f"{d}/links.parquet", readers.LINKS).select("polygon_id", "document_id")


@query("SELECT polygon_id, osm_id, NULL::VARCHAR AS not_there FROM polygons")
def scan_tolerant(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("polygon_id", T.StringType()), T.StructField("osm_id", T.LongType()), T.StructField("not_there", T.StringType())])
    return readers.read_tolerant(s, [f"{d}/polygons.parquet", f"{d}/no_such_table.parquet"], schema)


@query("SELECT r_regionkey AS k, r_name AS name FROM region UNION ALL SELECT n_nationkey, n_name FROM nation")
def scan_glob(s: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(n, k) for n, k in (("r_regionkey", T.IntegerType()), ("n_nationkey", T.IntegerType()), ("r_name", T.StringType()), ("n_name", T.StringType()))])
    return readers.read_glob(s, f"{d}/[nr]*ion.parquet", schema).select(F.coalesce("r_regionkey", "n_nationkey").alias("k"), F.coalesce("r_name", "n_name").alias("name"))


@query("SELECT polygon_id, osm_id::DOUBLE AS osm_id, lat, lon FROM polygons WHERE polygon_id IS NOT NULL AND name IS NOT NULL UNION ALL SELECT polygon_id, osm_id::DOUBLE, lat, lon FROM website WHERE polygon_id IS NOT NULL AND name IS NOT NULL")
def scan_union_by_name(s: SparkSession, d: str) -> DataFrame:
    """Two tables under each other by name, cast to one schema, rows without an id or a name left out."""
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(n, k) for n, k in (("polygon_id", T.StringType()), ("name", T.StringType()), ("osm_id", T.DoubleType()), ("lat", T.DoubleType()), ("lon", T.DoubleType()))])
    return readers.read_union(s, [f"{d}/polygons.parquet", f"{d}/website.parquet"], schema, ("polygon_id", "name")).drop("name")


@query("SELECT unnest(['customer','documents','embeddings','eval_items','events','lineitem','links','nation','orders','part','polygons','region','release_rows','supplier','website']) AS stem")
def region_stems(s: SparkSession, d: str) -> DataFrame:
    return s.createDataFrame([(x,) for x in readers.stems(s, d)], "stem string")


# --- geometry and rasters ------------------------------------------------------------------------------------------


# Rings of the given polygons, all of one ring, read by the JSON functions of SQL; validity by every pair of sides.
RINGS = """g AS (SELECT row_number() OVER () AS gid, polygon_id, geometry, CASE WHEN json_valid(geometry) AND json_extract_string(geometry, '$.type') = 'Polygon' THEN from_json(json_extract(geometry, '$.coordinates'), '[[["DOUBLE"]]]') END AS rings FROM polygons),
  pts AS (SELECT gid, polygon_id, unnest(rings[1]) AS xy, generate_subscripts(rings[1], 1) AS i FROM g WHERE rings IS NOT NULL),
  seg AS (SELECT a.gid, a.polygon_id, a.i, a.xy[1] AS x0, a.xy[2] AS y0, b.xy[1] AS x1, b.xy[2] AS y1, max(b.i) OVER (PARTITION BY a.gid) - 1 AS n FROM pts a JOIN pts b ON a.gid = b.gid AND b.i = a.i + 1),
  met AS (SELECT DISTINCT a.gid FROM seg a JOIN seg b ON a.gid = b.gid AND b.i > a.i + 1 AND NOT (a.i = 1 AND b.i = a.n)
    WHERE ((a.x1 - a.x0) * (b.y0 - a.y0) - (a.y1 - a.y0) * (b.x0 - a.x0)) * ((a.x1 - a.x0) * (b.y1 - a.y0) - (a.y1 - a.y0) * (b.x1 - a.x0)) <= 0
      AND ((b.x1 - b.x0) * (a.y0 - b.y0) - (b.y1 - b.y0) * (a.x0 - b.x0)) * ((b.x1 - b.x0) * (a.y1 - b.y0) - (b.y1 - b.y0) * (a.x1 - b.x0)) <= 0),
  area AS (SELECT gid, any_value(polygon_id) AS polygon_id, sum((x0 - ox) * (y1 - oy) - (x1 - ox) * (y0 - oy)) / 2 AS a, sum((x0 + x1 - 2 * ox) * ((x0 - ox) * (y1 - oy) - (x1 - ox) * (y0 - oy))) / 6 AS mx, sum((y0 + y1 - 2 * oy) * ((x0 - ox) * (y1 - oy) - (x1 - ox) * (y0 - oy))) / 6 AS my, any_value(ox) AS ox, any_value(oy) AS oy, max(n) AS n
    FROM (SELECT *, first_value(x0) OVER (PARTITION BY gid ORDER BY i) AS ox, first_value(y0) OVER (PARTITION BY gid ORDER BY i) AS oy FROM seg) GROUP BY gid),
  fit AS (SELECT * FROM area WHERE n >= 3 AND a <> 0 AND gid NOT IN (SELECT gid FROM met) AND gid IN (SELECT gid FROM g WHERE rings[1][1] = rings[1][-1]))"""


@query(f"WITH {RINGS} SELECT rings IS NOT NULL AS parsed, gid IN (SELECT gid FROM fit) AS usable, count(*) AS n FROM g GROUP BY 1, 2")
def geometry_usable(s: SparkSession, d: str) -> DataFrame:
    m = geo.measures(read_table(s, d, "polygons"))
    return m.groupBy("parsed", "usable").agg(F.count("*").alias("n"))


@query(f"WITH {RINGS} SELECT polygon_id, rings IS NOT NULL AS parsed, coalesce(len(rings[1]), 0)::BIGINT AS points FROM g")
def geojson_parse(s: SparkSession, d: str) -> DataFrame:
    return geo.measures(read_table(s, d, "polygons")).select("polygon_id", "parsed", "points")


@query(f"WITH {RINGS} SELECT polygon_id, round(ox + mx / a, 7) AS cx, round(oy + my / a, 7) AS cy, round(log10(abs(a)), 5) AS log_area FROM fit")
def poly_centroid(s: SparkSession, d: str) -> DataFrame:
    m = geo.measures(read_table(s, d, "polygons")).where("usable")
    return m.select("polygon_id", F.round("cx", 7).alias("cx"), F.round("cy", 7).alias("cy"), F.round(F.log10("area"), 5).alias("log_area"))


#: A synthetic raster of quarter-degree cells, one tile per three degrees: class by row and column.
CELL = 0.25
CODE = "(((({r}) * 7 + ({c}) * 13) % 11) * 10 + 10)"


def _raster(s: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Grids and blocks of 12 x 12 cells for the whole globe; the class of a cell is arithmetic on its place."""
    t = s.range(60 * 120).select(((F.col("id") / 120).cast("int") * 3 - 90).alias("tile_lat"), ((F.col("id") % 120).cast("int") * 3 - 180).alias("tile_lon"))
    t = t.withColumn("tile", grid.tile_name(F.col("tile_lat"), F.col("tile_lon")))
    x0, y0 = F.col("tile_lon").cast("double"), (F.col("tile_lat") + 3).cast("double")
    grids = t.select("tile", "tile_lat", "tile_lon", x0.alias("x0"), y0.alias("y0"), F.lit(CELL).alias("dx"), F.lit(CELL).alias("dy"), F.lit(12).alias("width"), F.lit(12).alias("height"))
    row, col = f"({{i}} + (87 - tile_lat) * 4)", f"({{i}} + (tile_lon + 180) * 4)"
    code = CODE.format(r=row.format(i="(i div 12)"), c=col.format(i="(i % 12)"))
    cells = F.expr(f"transform(sequence(0, 143), i -> unhex(lpad(hex({code}), 2, '0')))")
    codes = F.expr("unhex(array_join(transform(_c, x -> hex(x)), ''))")
    raster = t.withColumn("_c", cells).select("tile", F.lit(0).alias("brow"), F.lit(0).alias("bcol"), F.lit(12).alias("height"), F.lit(12).alias("width"), codes.alias("codes"))
    return grids, raster


BOXED = "boxed AS (SELECT o_orderkey AS polygon_id, (o_orderkey * 7919 % 33000) / 100.0::DOUBLE - 165 AS w, (o_orderkey * 10477 % 15000) / 100.0::DOUBLE - 75 AS s, ((o_custkey % 97) + 1) / 60.0::DOUBLE AS dx, ((o_custkey % 53) + 1) / 40.0::DOUBLE AS dy FROM orders)"


def _boxes(s: SparkSession, d: str) -> DataFrame:
    o = read_table(s, d, "orders")
    w, south = (F.col("o_orderkey") * 7919 % 33000) / 100 - 165, (F.col("o_orderkey") * 10477 % 15000) / 100 - 75
    b = o.select(F.col("o_orderkey").alias("polygon_id"), w.alias("w"), south.alias("s"), (w + ((F.col("o_custkey") % 97) + 1) / 60).alias("e"), (south + ((F.col("o_custkey") % 53) + 1) / 40).alias("n"))
    pt = lambda x, y: F.concat(F.lit("["), F.col(x).cast("string"), F.lit(","), F.col(y).cast("string"), F.lit("]"))
    ring = F.concat_ws(",", pt("w", "s"), pt("e", "s"), pt("e", "n"), pt("w", "n"), pt("w", "s"))
    return b.withColumn("geometry", F.concat(F.lit('{"type":"Polygon","coordinates":[['), ring, F.lit("]]}")))


OVERLAP = f"""{BOXED}, ij AS (SELECT polygon_id, w, s, w + dx AS e, s + dy AS n, unnest(range(floor((w + 180) * 4)::BIGINT, floor((w + dx + 180) * 4)::BIGINT + 1)) AS c FROM boxed),
  cells AS (SELECT *, unnest(range(floor((90 - n) * 4)::BIGINT, floor((90 - s) * 4)::BIGINT + 1)) AS r FROM ij),
  part AS (SELECT polygon_id, {CODE.format(r='r', c='c')} AS code, r, c, greatest(0, least(e, (c + 1) / 4.0::DOUBLE - 180) - greatest(w, c / 4.0::DOUBLE - 180)) * greatest(0, least(n, 90 - r / 4.0::DOUBLE) - greatest(s, 90 - (r + 1) / 4.0::DOUBLE)) AS a, (e - w) * (n - s) AS whole FROM cells)"""


@query(f"WITH {OVERLAP} SELECT polygon_id, code::INT AS code, round(sum(a) / max(whole), 5) AS share FROM part GROUP BY 1, 2 HAVING sum(a) / max(whole) > 1e-6")
def zonal_coverage(s: SparkSession, d: str) -> DataFrame:
    got = zonal.zonal_coverage(_boxes(s, d), *_raster(s)).where("share > 1e-6")
    return got.select("polygon_id", "code", F.round("share", 5).alias("share"))


@query(f"WITH {OVERLAP} SELECT r % 12 AS row, count(DISTINCT polygon_id) AS polygons FROM part WHERE a > 1e-9 GROUP BY 1")
def raster_cells(s: SparkSession, d: str) -> DataFrame:
    """How many boxes cover a part of each raster row of a tile, from the rows that the kernel emits."""
    grids, raster = _raster(s)
    rows = zonal.covered_rows(zonal.polygon_blocks(_boxes(s, d), grids), raster).where("cells * dx * dy > 1e-9")
    return rows.groupBy(F.col("row").cast("long").alias("row")).agg(F.countDistinct("pid").alias("polygons"))


Q = "((1 - 0.0066943799901413165) * (sin(radians({0})) / (1 - pow(0.08181919084262149 * sin(radians({0})), 2)) - ln((1 - 0.08181919084262149 * sin(radians({0}))) / (1 + 0.08181919084262149 * sin(radians({0})))) / (2 * 0.08181919084262149)))"


@query(f"WITH {BOXED} SELECT polygon_id, round(radians(dx) * ({Q.format('(s + dy)')} - {Q.format('s')}) * (6378137.0::DOUBLE * 6378137.0::DOUBLE / 2) / 1e6, 1) AS km2 FROM boxed")
def cea_area(s: SparkSession, d: str) -> DataFrame:
    b = _boxes(s, d)
    return b.select("polygon_id", F.round(projection.box_area_m2(F.col("w"), F.col("s"), F.col("e"), F.col("n")) / 1e6, 1).alias("km2"))


K0 = "(cos(radians(30.0::DOUBLE)) / sqrt(1 - 0.0066943799901413165 * pow(sin(radians(30.0::DOUBLE)), 2)))"


@query(f"WITH {BOXED} SELECT polygon_id, round(radians(w) * 6378137.0::DOUBLE * {K0}, 1) AS x, round({Q.format('(s + dy)')} * 6378137.0::DOUBLE / (2 * {K0}), 1) AS y FROM boxed")
def cea_project(s: SparkSession, d: str) -> DataFrame:
    """Projected north-west corners of boxes in metres."""
    b = _boxes(s, d)
    x, y = projection.project(F.col("n"), F.col("w"))
    return b.select("polygon_id", F.round(x, 1).alias("x"), F.round(y, 1).alias("y"))


# Along an edge cut into k pieces, curve and chord of the equal-area plane enclose at most a^2 max|q''| dlon dlat^2 / (24 k^2).
CHORD = "6378137.0::DOUBLE * 6378137.0::DOUBLE * (2 / (1 - 0.0066943799901413165)) / 24 * radians(abs(x1 - x0)) * pow(radians(y1 - y0), 2) / pow(greatest(1, ceil(sqrt(pow(x1 - x0, 2) + pow(y1 - y0, 2)) / 0.01::DOUBLE)), 2)"
INSIDE_AREA = f"abs(sum(radians(x1 - x0) * ({Q.format('y0')} + {Q.format('y1')}))) * 6378137.0::DOUBLE * 6378137.0::DOUBLE / 4"
ONE_SHAPE = "shape AS (SELECT min(gid) AS gid FROM g WHERE gid IN (SELECT gid FROM fit) GROUP BY polygon_id)"


@query(f"WITH {RINGS}, {ONE_SHAPE}, b AS (SELECT gid, sum({CHORD}) AS bound FROM seg WHERE gid IN (SELECT gid FROM fit) GROUP BY gid) SELECT geometry, max(CASE WHEN bound > 0 THEN round(log10(bound), 5) ELSE -99.0 END) AS log_bound FROM b JOIN g ON b.gid = g.gid GROUP BY 1")
def cea_bound(s: SparkSession, d: str) -> DataFrame:
    """By how much the area of each polygon's chords in the equal-area plane may differ from that of its edges: logarithm of square metres."""
    f = equalarea.facts(read_table(s, d, "polygons").where("geometry is not null").select("geometry").distinct(), "geometry", "geometry").where("reason is null")
    return f.select("geometry", F.when(F.col("bound") > 0, F.round(F.log10("bound"), 5)).otherwise(F.lit(-99.0)).alias("log_bound"))


EVIDENCE = f"""{RINGS}, w AS (SELECT gid, {INSIDE_AREA} AS whole, min(least(x0, x1)) AS west, max(greatest(x0, x1)) AS east, min(least(y0, y1)) AS south, max(greatest(y0, y1)) AS north FROM seg WHERE gid IN (SELECT gid FROM fit) GROUP BY gid),
  told AS (SELECT g.geometry, any_value(whole) AS whole, any_value(west) AS west, any_value(east) AS east, any_value(south) AS south, any_value(north) AS north FROM w JOIN g ON w.gid = g.gid GROUP BY 1)"""


@query(f"WITH {EVIDENCE} SELECT geometry, round(log10(whole), 4) AS log_area, CASE WHEN floor(west / 3) = floor(east / 3) AND floor(south / 3) = floor(north / 3) THEN {TNAME.format(TILE.format('south'), TILE.format('west'))} END AS tile FROM told")
def tile_evidence(s: SparkSession, d: str) -> DataFrame:
    """Class areas add up to each polygon's own area on the ellipsoid, as the raster has no cell without class; and the tile that gave them, where it is one."""
    p = read_table(s, d, "polygons").where("geometry is not null").select("geometry").distinct()
    got = zonal.equal_area_coverage(p, *_raster(s), key="geometry")
    by = got.groupBy("geometry").agg(F.sum("area_m2").alias("a"), F.array_distinct(F.flatten(F.collect_list("tiles"))).alias("tiles"))
    return by.select("geometry", F.round(F.log10("a"), 4).alias("log_area"), F.when(F.size("tiles") == 1, F.col("tiles")[0]).alias("tile"))


@query(f"""WITH {EVIDENCE}, rows AS (SELECT g.gid, nullif(trim(g.polygon_id), '') AS id, g.geometry, g.gid IN (SELECT gid FROM fit) AS usable FROM g)
  SELECT CASE WHEN id IS NULL THEN 'source_polygon_id_missing' WHEN NOT usable THEN 'geometry_unusable' END AS error, count(*) AS rows, round(log10(sum(CASE WHEN id IS NOT NULL AND usable THEN whole END)), 4) AS log_area
  FROM rows LEFT JOIN told ON rows.geometry = told.geometry GROUP BY 1""")
def sourcewide_attempts(s: SparkSession, d: str) -> DataFrame:
    """One record per raw row: how many have each error, and what the measured polygons' class areas add up to."""
    got = equalarea.attempts(read_table(s, d, "polygons"), *_raster(s))
    area = F.aggregate("class_areas", F.lit(0.0), lambda a, x: a + x["area"])
    return got.groupBy("error").agg(F.count("*").alias("rows"), F.round(F.log10(F.sum(area)), 4).alias("log_area"))


RATIO = "least(greatest((dominant_fraction - 0.01::DOUBLE) / (observed_fraction + 0.01::DOUBLE), 0.0::DOUBLE), 1e9::DOUBLE)"


@query(f"""WITH e AS (SELECT example_id, greatest(0.0::DOUBLE, (dominant_fraction - 0.01::DOUBLE) / (observed_fraction + 0.01::DOUBLE)) AS lo,
   CASE WHEN greatest(observed_fraction - 0.01::DOUBLE, 0.0::DOUBLE) = 0 THEN 1.0 ELSE least(1.0::DOUBLE, (dominant_fraction + 0.01::DOUBLE) / greatest(observed_fraction - 0.01::DOUBLE, 0.0::DOUBLE)) END AS hi FROM release_rows)
   SELECT example_id, round(lo, 6) AS lower, round(hi, 6) AS upper, lo < 0.8::DOUBLE AND hi >= 0.8::DOUBLE AS crosses FROM e""")
def ratio_enclosure(s: SparkSession, d: str) -> DataFrame:
    r = _rows(s, d).select("example_id", projection.ratio_enclosure(F.col("dominant_fraction"), F.col("observed_fraction"), F.lit(0.01)).alias("x"))
    return r.select("example_id", F.round("x.lower", 6).alias("lower"), F.round("x.upper", 6).alias("upper"), "x.crosses")


@query()
def file_sha256(s: SparkSession, d: str) -> DataFrame:
    """Every Parquet file of the folder, named by its path in it."""
    return ledger.file_digests(s, d).withColumnRenamed("path", "file")


assert SPLITS
