import struct

from pyspark.sql import functions as F

from cartolex.plans import release
from cartolex.schema import LINKS, POLYGONS
from cartolex.sources import readers
from cartolex.streaming import incremental


def test_description_layout(spark):
    wkb = struct.pack("<BIII", 1, 3, 1, 5) + struct.pack("<10d", 0, 0, 2, 0, 2, 2, 0, 2, 0, 0)
    pairs = [("fr", " bonjour "), ("description:de", "hallo"), ("es", "  "), ("it", None), (None, "x")]
    raw = spark.createDataFrame([("way", 7, "u", "n", " hello ", pairs, 5.0, wkb, "pbf")], "osm_type string, osm_id long, osm_url string, name string, description string, localized_descriptions array<struct<key:string,value:string>>, area_m2 double, geometry binary, source_pbf string")
    links, docs = readers.description_documents(raw, F.lit("x-latest"))
    got = {(r["document_id"], r["language"], r["full_text"]) for r in docs.collect()}
    assert got == {("x-latest:way/7:description", None, "hello"), ("x-latest:way/7:description:fr", "fr", "bonjour"), ("x-latest:way/7:description:de", "de", "hallo")}
    assert links.count() == 3 and links.columns == LINKS.names
    p = readers.description_polygons(raw, F.lit("x-latest")).first()
    assert (p["polygon_id"], p["region"], p["lat"], p["lon"]) == ("x-latest:way/7", "x", 1.0, 1.0)


def test_website_layout(spark):
    row = ("p", None, "text", "success", "eng_Latn", "c", " ", "success", None)
    names = "polygon_id string, region string, website_text string, website_text_status string, website_language string, contact_website string, contact_website_text string, contact_website_text_status string, contact_website_language string"
    raw = spark.createDataFrame([row, ("q", "r", "t", None, None, None, "more", "timeout", None)], names).withColumns({"website": F.lit("u"), "name": F.lit("n")})
    docs = readers.website_documents(raw)[1].collect()
    assert [(r["document_id"], r["language"], r["full_text"]) for r in docs] == [("p:website", "eng_Latn", "text")]
    assert [r["region"] for r in readers.website_polygons(raw, F.lit("z-latest")).collect()] == ["z", "r"]


def test_tolerant_scan(spark, tmp_path):
    assert readers.read_tolerant(spark, str(tmp_path / "none.parquet"), POLYGONS).count() == 0
    spark.createDataFrame([("p", 1)], "polygon_id string, extra int").write.parquet(str(tmp_path / "a.parquet"))
    df = readers.read_tolerant(spark, [str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet")], POLYGONS)
    assert df.columns == POLYGONS.names and df.first()["polygon_id"] == "p" and df.first()["name"] is None
    assert readers.stems(spark, str(tmp_path)) == ["a"] and readers.stems(spark, str(tmp_path / "no")) == []


def test_release_is_ordered_and_repeatable(spark, sf, tmp_path):
    rows = spark.read.parquet(f"{sf}/release_rows.parquet")
    a, b = release.build(spark, rows, str(tmp_path / "a")), release.build(spark, rows, str(tmp_path / "b"))
    assert a == b and a["counts"]["examples"]["total"] > 0
    for name in ("train", "validation", "test"):
        got = [[tuple(r) for r in spark.read.parquet(str(tmp_path / x / f"{name}.parquet")).select("polygon_id", "document_id", "example_id").collect()] for x in "ab"]
        assert sorted(got[0]) == sorted(got[1]) and len(got[0]) == a["counts"]["examples"][name]


def test_single_files_have_equal_bytes(spark, sf, tmp_path):
    kept = spark.read.parquet(f"{sf}/release_rows.parquet")
    for x in "ab":
        release.write_splits(kept, str(tmp_path / x), single_file=True)
    for name in ("train", "validation", "test"):
        one, two = ([p.read_bytes() for p in (tmp_path / x / f"{name}.parquet").glob("*.parquet")] for x in "ab")
        assert len(one) == 1 and one == two


def test_places_count_every_split(spark):
    df = spark.createDataFrame([(s, i) for s in ("train", "test", None) for i in range(40, 0, -1)], "split string, k int")
    got = {(r["split"], r["k"]): r["place"] for r in release.ordered_places(df, "split", ["k"]).collect()}
    assert all(place == k for (_, k), place in got.items()) and len(got) == 120


def test_new_files_are_processed_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    schema = spark.range(1).schema
    for n in (5, 7):
        spark.range(n).coalesce(1).write.mode("append").parquet(src)
        incremental.process(incremental.new_regions(spark, src, schema), lambda b: b.drop("_file"), out, ck)
    assert spark.read.parquet(out).count() == 12
