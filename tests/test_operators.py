import pytest
from pyspark.sql import functions as F

from cartolex.operators import checks, dedup, examples, labels, ledger, summary

COVER = "polygon_id string, code int, area double, polygon_area double"


def verdicts(spark, rows, **k):
    return {r["polygon_id"]: r for r in labels.dominance(spark.createDataFrame(rows, COVER), **k).collect()}


def test_dominance_cases(spark):
    v = verdicts(spark, [
        ("win", 10, 8.0, 10.0), ("win", 20, 2.0, 10.0), ("under", 10, 7.9, 10.0), ("tie", 30, 5.0, 10.0), ("tie", 20, 5.0, 10.0), ("nodata", 0, 9.0, 10.0),
        ("unknown", 11, 9.0, 10.0), ("over", 10, 10.2, 10.0), ("little", 10, 10.05, 10.0), ("empty", 10, 1.0, 0.0), ("twice", 10, 4.0, 10.0), ("twice", 10, 4.0, 10.0),
    ])
    assert v["win"].accepted and v["win"].code == 10 and v["win"].observed == 1.0
    assert v["under"].reason == v["tie"].reason == "below_threshold" and v["tie"].code == 20
    assert v["nodata"].reason == v["unknown"].reason == v["over"].reason == "no_valid_class"
    assert v["little"].accepted and v["little"].fraction == 1.0
    assert v["empty"].reason == "empty_polygon" and v["twice"].accepted


@pytest.mark.parametrize("t", [0, -1, 1.1])
def test_threshold_range(spark, t):
    with pytest.raises(ValueError):
        labels.dominance(spark.createDataFrame([], COVER), threshold=t)


def test_dominance_of_nothing(spark):
    assert labels.dominance(spark.createDataFrame([], COVER)).count() == 0


def test_area_cap(spark):
    df = spark.createDataFrame([(1e10,), (1.1e10,), (float("nan"),), (None,)], "a double")
    assert [r[0] for r in df.select(labels.within_area_cap(F.col("a"))).collect()] == [True, False, False, False]


def test_text_funnel_counts_the_furthest_stage(spark):
    lab = spark.createDataFrame([(p,) for p in "abcdef"], "polygon_id string")
    links = spark.createDataFrame([("b", "x"), ("c", "failed"), ("d", "blank"), ("e", "short"), ("f", "good"), ("f", "blank"), (None, "good")], "polygon_id string, document_id string")
    docs = spark.createDataFrame([("failed", "w " * 20, "error"), ("blank", "  ", "ok"), ("short", "one two", "ok"), ("good", "w " * 10, "ok")], "document_id string, full_text string, fetch_status string")
    got = {r["reason"]: r["n"] for r in examples.text_losses(examples.staged(lab, links, docs)).collect()}
    assert got == dict.fromkeys(examples.STAGES, 1)
    base = lab.selectExpr("polygon_id", "10L as worldcover_code", "1.5D as lat", "-2.0D as lon", "3.0D as area_m2")
    out = examples.to_examples(base, links, docs.withColumn("language", F.lit("en"))).collect()
    assert [(r["polygon_id"], r["text_words"], r["worldcover_label"], r["centroid_wkt"], r["language"]) for r in out] == [("f", 10, "Tree cover", "POINT (-2 1.5)", "en")]


def test_null_ids_join_only_on_demand(spark):
    a = spark.createDataFrame([(None,), ("x",)], "polygon_id string")
    b = spark.createDataFrame([(None, "d"), ("x", "d")], "polygon_id string, document_id string")
    assert examples.join_links(a, b).count() == 1 and examples.join_links(a, b, null_safe=True).count() == 2


ROWS = "example_id long, osm_type string, osm_id long, region string, polygon_id string, document_id string, text string, text_words long, worldcover_code long, split string"


def row(i, obj=1, region="a", pid="a:1", doc="d", text="some text", code=10, split="train"):
    return (i, "way", obj, region, pid, doc, text, len(text.split()), code, split)


def kept_ids(spark, rows):
    return sorted(r["example_id"] for r in dedup.chain(spark.createDataFrame(rows, ROWS))["kept"].collect())


def test_chain_scenarios(spark):
    assert kept_ids(spark, [row(1, region="b", pid="b:1"), row(2)]) == [2]  # one object seen from two regions
    assert kept_ids(spark, [row(1), row(2, obj=2, pid="a:2", doc="e")]) == [1, 2]  # equal text, distinct polygons
    assert kept_ids(spark, [row(1), row(2, doc="e", text="some  text")]) == [1]  # equal polygon, text and label
    assert kept_ids(spark, [row(1), row(2, doc="e", code=20)]) == [1, 2]  # two labels
    many = [row(i, obj=i, pid=f"a:{i}", split="train" if i < 3 else "test") for i in range(1, 6)]
    assert kept_ids(spark, many) == [3, 4, 5]  # a document keeps its majority split
    assert kept_ids(spark, []) == []


def test_duplicate_counts(spark):
    rows = [row(1), row(2, doc="e"), row(3, doc="f", split="test"), row(4, obj=2, pid="z", doc="g", text="alone")]
    objects = dedup.chain(spark.createDataFrame(rows, ROWS))["objects"]
    assert tuple(dedup.duplicate_summary(objects).first()) == (1, 2, 1, 2)
    assert {r["words"]: r["removed"] for r in dedup.duplicates_by_words(objects).collect() if r["removed"]} == {"2": 2}


def test_split_counts_have_all_splits(spark):
    kept = spark.createDataFrame([("train", "p", "d"), ("train", "p", "e")], "split string, polygon_id string, document_id string")
    got = {r["split"]: tuple(r)[1:] for r in summary.split_counts(kept).collect()}
    assert got == {"train": (2, 1, 2), "validation": (0, 0, 0), "test": (0, 0, 0), "total": (2, 1, 2)}


def test_null_is_a_language_of_its_own(spark):
    df = spark.createDataFrame([("en",), (None,), (None,), ("de",)], "language string")
    by = summary.distribution(df, "language")
    assert [r["language"] for r in by.orderBy(*summary.by_frequency(by, "language")).collect()] == [None, "de", "en"]


def test_report_has_the_smallest_samples(spark):
    v = spark.createDataFrame([("c", f"p{i:02d}") for i in range(9, -1, -1)] + [("d", None)], "code string, culprit string")
    got = {r["code"]: (r["n"], r["samples"]) for r in checks.report(v).collect()}
    assert got == {"c": (10, [f"p{i:02d}" for i in range(5)]), "d": (1, [])} or got["d"][1] == [None]


def test_finite(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (None,)], "x double")
    assert [r[0] for r in df.select(checks.finite(F.col("x"))).collect()] == [True, False, False, False]


def test_struct_distinct_counts_nulls(spark):
    df = spark.createDataFrame([("p", None, 1.0, 1.0, 1.0, "c"), ("p", 10, 1.0, 1.0, 1.0, "c"), ("q", 10, 1.0, 1.0, 1.0, "c"), ("q", 10, 1.0, 1.0, 1.0, "d")], "polygon_id string, worldcover_code long, lat double, lon double, polygon_area_m2 double, h3_cell string")
    assert checks.inconsistent_polygons(df).count() == 2


def test_null_keys_leak_like_others(spark):
    df = spark.createDataFrame([(None, "train"), (None, "test"), ("a", "train")], "polygon_id string, split string")
    assert [tuple(r) for r in checks.leaking(df, "polygon_id").collect()] == [(None, 2)]


def test_samples_repeat_as_culprits_do(spark):
    df = spark.createDataFrame([("c", "b", 1 << 33), ("c", "a", 2), ("d", None, 1)], "code string, culprit string, times long")
    got = {r["code"]: (r["n"], r["samples"]) for r in checks.report(df).collect()}
    assert got == {"c": ((1 << 33) + 2, ["a", "a", "b", "b", "b"]), "d": (1, [None])}


def test_ledger(spark):
    a, b = (spark.createDataFrame([(x,) for x in t], "stem string") for t in ("abb", "bc"))
    assert [r[0] for r in ledger.gaps(a, b).collect()] == ["a"] and [r[0] for r in ledger.overlap(a, b).collect()] == ["b"]
    assert tuple(ledger.equal(a, b).first()) == (2, 1, False)
    maps = spark.createDataFrame([({"x": 1},), ({"x": 2, "y": 3},)], "m map<string,int>")
    assert {r["reason"]: r["n"] for r in ledger.merge_counts(maps, "m").collect()} == {"x": 3, "y": 3}


def test_every_file_has_a_digest(spark, sf, tmp_path):
    import hashlib
    from pathlib import Path

    from cartolex.queries import file_sha256

    got = {r["file"]: (r["length"], r["sha256"]) for r in file_sha256(spark, sf).collect()}
    files = {str(p.relative_to(sf)): p.read_bytes() for p in Path(sf).rglob("*.parquet") if p.is_file()}
    assert got == {k: (len(x), hashlib.sha256(x).hexdigest()) for k, x in files.items()}
    (tmp_path / "t a.parquet").mkdir()
    (tmp_path / "t a.parquet" / "part%20 0.parquet").write_bytes(b"x" * 3_000_000)
    (tmp_path / "other.txt").write_bytes(b"y")
    rows = [(r["file"], r["length"], r["sha256"]) for r in file_sha256(spark, str(tmp_path)).collect()]
    assert rows == [("t a.parquet/part%20 0.parquet", 3_000_000, hashlib.sha256(b"x" * 3_000_000).hexdigest())]
