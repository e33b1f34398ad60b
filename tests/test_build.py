import numpy as np
import pytest

from cartolex.__main__ import main
from cartolex.operators import summary, zonal
from cartolex.plans import build, release
from cartolex.schema import DOCUMENTS, LINKS, POLYGONS, RELEASE

WORDS = " ".join(f"w{i}" for i in range(12))


def world(spark):
    codes = np.array([[10, 10, 50, 50]] * 4, np.uint8)
    grids = spark.createDataFrame([("N00E000", 0, 0, 0.0, 4.0, 1.0, 1.0, 4, 4)], zonal.GRID)
    return grids, spark.createDataFrame([("N00E000", *b) for b in zonal.blocks_of(codes)], zonal.RASTER)


def polygon(i, box, area=1.0):
    return (f"r-latest:way/{i}", "r", "way", i, None, f"n{i}", 1.0, 1.0, zonal.box_geojson(*box) if box else "{", area, "pbf")


def test_every_polygon_is_accounted_for(spark, tmp_path):
    polygons = spark.createDataFrame([polygon(1, (0, 0, 2, 2)), polygon(1, (0, 0, 2, 2)), polygon(2, (0, 0, 2.9, 2)), polygon(3, (0, 0, 1, 1), 2e10), polygon(4, None), polygon(5, (50, 50, 51, 51)), polygon(6, (0.5, 0.5, 1.5, 1.5))], POLYGONS)
    links = spark.createDataFrame([(f"r-latest:way/{i}", f"d{i}", "w", None, "[]") for i in range(1, 6)], LINKS)
    docs = spark.createDataFrame([(f"d{i}", "en", "t", "u", None, WORDS, None, "ok", None, "w") for i in range(1, 6)], DOCUMENTS)
    labelled, verdicts = build.label_polygons(polygons, *world(spark))
    reasons = {r["polygon_id"][-1]: r["reason"] for r in verdicts.collect()}
    assert reasons == {"1": None, "2": "below_threshold", "3": "too_large", "4": "invalid", "5": "no_valid_class", "6": None}
    rows, outcomes = build.build_examples(polygons, links, docs, *world(spark))
    assert rows.columns == [*RELEASE.names, "example_id"]
    got = rows.collect()
    assert [(r["polygon_id"], r["worldcover_code"], r["split"] in ("train", "validation", "test")) for r in got] == [("r-latest:way/1", 10, True)]
    o = outcomes.first()
    assert (o["polygons_seen"], o["polygons_repeated"], o["polygons_invalid"], o["polygons_accepted"], o["polygons_with_examples"], o["examples"]) == (6, 1, 1, 2, 1, 1)
    assert (o["rejections"], o["text_rejections"], o["tiles_missing"]) == ({"below_threshold": 1, "no_valid_class": 1, "too_large": 1}, {"no_source_document": 1}, ["N48E048"])
    path = str(tmp_path / "rows.parquet")
    rows.write.parquet(path)
    assert release.build(spark, spark.read.parquet(path), str(tmp_path / "out"))["violations"] == {}
    assert main(["validate", *[str(tmp_path / "out" / f"{n}.parquet") for n in ("train", "validation", "test")]]) == 0
    assert main(["audit", path]) == 0


def test_language_counts_add_up(spark, sf, monkeypatch):
    monkeypatch.setattr(release, "NAMED", 2)
    rows = spark.read.parquet(f"{sf}/release_rows.parquet")
    out = release.manifest(rows)
    kinds = rows.select("language").distinct().count()
    assert kinds > 2 and len(out["language_distribution"]) == 2 and out["languages_other"]["labels"] == kinds - 2
    assert sum(x["examples"] for x in out["language_distribution"]) + out["languages_other"]["examples"] == rows.count()


def test_rows_of_one_id_are_still_told_apart(spark, sf):
    """An id that all rows share keeps no row that deduplication removes."""
    from pyspark.sql import functions as F

    rows = spark.read.parquet(f"{sf}/release_rows.parquet")
    one, removed, _ = release.global_pass(rows.withColumn("example_id", F.lit(1).cast("long")))
    many, same, _ = release.global_pass(rows)
    assert one.count() == many.count() == rows.count() - sum(same.values()) and removed == same and sum(same.values()) > 0


def test_exact_quantiles(spark):
    import random

    rng = random.Random(2)
    for n in (0, 1, 2, 3, 50, 999):
        values = [rng.choice([0.1, 0.5, rng.random()]) for _ in range(n)]
        got = summary.order_statistics(spark.createDataFrame([(v,) for v in [*values, None]], "x double").repartition(3), "x", (0.0, 0.5, 0.9, 1.0))
        assert got == ([None] * 4 if not n else pytest.approx([float(np.quantile(values, q)) for q in (0.0, 0.5, 0.9, 1.0)], rel=1e-12))
