"""From sources to a promoted release in one call, resumed where it stopped; and the assembly of several workers' shards."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.runtime import materialise
from ..publication.accounting import LATE_SETTINGS, ledger
from ..publication.locks import scratch_lock, write_lock
from ..publication.promotion import new_stage, promote, recover, target_path
from ..publication.receipts import ShardStore, outcome_records
from ..publication.storage import clear_marks
from ..schema import RELEASE
from ..sources.catalog import SourceCatalog, TileSource
from ..sources.recipes import recipe_for
from . import build, release

CONTEXT = 1


def context_of(settings: build.Settings) -> dict:
    """What a region's shard depends on: all settings, the code and the columns; not where it is kept or which regions are chosen."""
    return {"version": CONTEXT, "settings": settings.as_manifest(), "code_revision": settings.code_revision, "columns": RELEASE.names}


def process_regions(spark: SparkSession, settings: build.Settings, catalog: SourceCatalog, tiles: TileSource, store: ShardStore, stems: list[str]) -> None:
    """Build the examples of all named regions in one job and commit a shard and a receipt for each.

    Only tiles that a polygon of these regions touches are read.
    """
    polygons, links, documents = catalog.load(settings.source_revision, stems)
    polygons = materialise(polygons)
    names = build.touched_tiles(polygons)
    grids, raster = tiles.table(names)
    examples, outcomes = build.build_examples(polygons, links, documents, grids, raster, settings, key="stem")
    examples = materialise(examples)
    records = {o["stem"]: o for o in outcome_records(outcomes)}
    for stem in stems:  # a region without a polygon is done, too
        records.setdefault(stem, {k: 0 for k in ("polygons_seen", "polygons_invalid", "polygons_accepted", "polygons_with_examples", "source_links", "source_documents", "examples")} | {"stem": stem, "rejections": {}, "text_rejections": {}, "tiles_missing": []})
    store.write(examples.select("stem", *RELEASE.names), [records[s] for s in stems])


def finalise(spark: SparkSession, rows: DataFrame, settings: build.Settings, out: str, book: dict | None = None, publishable: bool = True) -> tuple[Path, dict, bool]:
    """(target, manifest, changed): the global pass into a stage, refused where it breaks a guarantee, else promoted."""
    target = target_path(Path(out), settings.dataset_version)
    target.parent.mkdir(parents=True, exist_ok=True)
    with write_lock(target):
        recover(target)
        stage = new_stage(target)
        said = settings.as_manifest() | ({} if publishable else {"publishable": False})
        m = release.build(spark, rows, str(stage), said, (book or {}).get("totals", {}).get("rejections"), book)
        if m["violations"]:
            import shutil

            shutil.rmtree(stage)
            raise ValueError(f"the release breaks its guarantees: {m['violations']}")
        clear_marks(stage)
        return target, m, promote(stage, target)


def run(spark: SparkSession, settings: build.Settings, sources: str, tiles: str, work: str, out: str, regions: list[str] | None = None) -> dict:
    """Sources to release. {target, changed, manifest, processed, skipped}.

    The revision is pinned first. Regions whose receipts hold are not processed again; unknown ones are refused. A subset
    of regions makes a release whose ledger says so.
    """
    catalog = SourceCatalog(spark, sources, recipe_for(settings.source))
    settings = settings.with_overrides(source_revision=catalog.resolve_revision(settings.source_revision or "main"))
    expected = catalog.regions(settings.source_revision)
    chosen = expected if regions is None else list(dict.fromkeys(regions))
    if unknown := sorted(set(chosen) - set(expected)):
        raise ValueError(f"unknown regions: {unknown}")
    if not chosen:
        raise ValueError("no regions")
    with scratch_lock(Path(work)):
        store = ShardStore(spark, Path(work) / "shards", context_of(settings))
        done = store.verified(chosen)
        pending = [s for s in chosen if s not in done]
        if pending:
            process_regions(spark, settings, catalog, TileSource(spark, tiles), store, pending)
            done = store.verified(chosen)
        book = ledger(expected, chosen, list(done.values()), store.context)
        if not book["selected_complete"]:
            raise ValueError(f"regions without a shard: {book['unprocessed_selected_regions']}")
        rows = store.read(sorted(done))
        rows = spark.createDataFrame([], RELEASE) if rows is None else rows
        target, m, changed = finalise(spark, rows, settings, out, book)
    return {"target": str(target), "changed": changed, "manifest": m, "processed": pending, "skipped": sorted(set(chosen) - set(pending))}


def compatible(a: dict, b: dict) -> bool:
    """Whether shards of two contexts may stand in one release: all but the late settings and the code revision are equal."""
    plain = lambda c: {k: v for k, v in c.items() if k not in ("settings", "code_revision")} | {"settings": {k: v for k, v in c["settings"].items() if k not in LATE_SETTINGS}}
    return plain(a) == plain(b)


def assemble(
    spark: SparkSession, folders: list[str], out: str, expected: list[str] | None = None, assertions: dict | None = None, assembly_revision: str | None = None, dataset_version: str | None = None,
) -> dict:
    """One release of the shards of several workers. {target, changed, manifest}.

    Every receipt is verified under the context it names; contexts must be compatible, no region may be in two folders, and
    `assertions` (settings that the caller insists on) must equal those of the receipts. Regions are grouped by the code
    revision that made them, where all of them have one.
    """
    import json

    stores: list[tuple[ShardStore, list[str]]] = []
    owner: dict[str, str] = {}
    for folder in folders:
        by: dict[str, tuple[dict, list[str]]] = {}
        receipts = sorted(Path(folder).glob("*.complete.json"))
        named = {p.name.removesuffix(".complete.json") for p in receipts} | {p.name[5:] for p in Path(folder).glob("stem=*")}
        if bare := sorted(named - {p.name.removesuffix(".complete.json") for p in receipts}):
            raise ValueError(f"{folder}: shards without a receipt: {bare}")
        for p in receipts:
            r = json.loads(p.read_text(encoding="utf-8"))
            by.setdefault(r["context_sha256"], (r["context"], []))[1].append(p.name.removesuffix(".complete.json"))
        for context, stems in by.values():
            store = ShardStore(spark, folder, context)
            if twice := sorted(s for s in stems if s in owner):
                raise ValueError(f"regions of two workers: {twice}")
            owner.update(dict.fromkeys(stems, folder))
            store.stage(stems)
            stores.append((store, stems))
    if not stores:
        raise ValueError("no shards")
    first = stores[0][0].context
    if any(not compatible(first, s.context) for s, _ in stores):
        raise ValueError("shards of settings that do not go together")
    kept = first["settings"]
    if wrong := {k: v for k, v in (assertions or {}).items() if v is not None and kept.get(k) != v}:
        raise ValueError(f"the shards have other settings than asked for: {wrong}")
    settings = build.Settings.from_manifest(kept).with_overrides(dataset_version=dataset_version)
    outcomes = [o for store, stems in stores for o in store.verified(stems).values()]
    revisions = {s: store.context.get("code_revision") for store, stems in stores for s in stems}
    told = all(revisions.values())
    stems = sorted(revisions)
    book = ledger(expected or stems, stems, outcomes, first, revisions if told and assembly_revision else None, assembly_revision if told else None)
    rows = None
    for store, names in stores:
        part = store.read(names)
        if part is not None:
            rows = part if rows is None else rows.unionByName(part)
    rows = spark.createDataFrame([], RELEASE) if rows is None else rows
    target, m, changed = finalise(spark, rows.withColumn("dataset_version", F.lit(settings.dataset_version)), settings, out, book)
    return {"target": str(target), "changed": changed, "manifest": m}


def gather(spark: SparkSession, folders: list[str], settings: build.Settings, out: str) -> dict:
    """A release of Parquet files of examples without receipts, from several folders; marked as not publishable."""
    paths = [str(p) for f in folders for p in sorted(Path(f).glob("*.parquet"))]
    if not paths:
        raise ValueError("no shards")
    rows = build.enrich(spark.read.parquet(*paths), settings)
    target, m, changed = finalise(spark, rows.select(*RELEASE.names), settings, out, publishable=False)
    return {"target": str(target), "changed": changed, "manifest": m}


def verify_threshold(option: float | None, manifest: dict | None, default: float) -> float:
    """The threshold to verify by: the option, else the manifest's, else the default; finite and in (0, 1]."""
    said = (manifest or {}).get("settings", {}).get("dominance_threshold")
    value = option if option is not None else said if said is not None else default
    if not isinstance(value, (int, float)) or isinstance(value, bool) or not 0 < value <= 1:
        raise ValueError(f"threshold must be in (0, 1]: {value!r}")
    return float(value)
