"""Command line: `python -m cartolex build|regions|assemble|verify|audit|publish|info|migrate-release-lock|release|query ...`."""

from __future__ import annotations

import argparse
import json
import os
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from .operators import checks
from .plans import release, run
from .plans.build import Settings
from .publication import audit as auditing
from .publication import locks, publish
from .schema import MIN_WORDS, THRESHOLD
from .sources.catalog import SourceCatalog, parse_regions
from .sources.recipes import RECIPES, recipe_for

OPTIONS = ("source", "source_dataset", "source_revision", "threshold", "least_words", "resolution", "seed", "dataset_version", "code_repository", "code_revision", "max_area_km2", "train", "validation", "test")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="cartolex", description=__doc__)
    sub = parser.add_subparsers(dest="what", required=True)

    def command(name: str, text: str, *places: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=text)
        for x in places:
            p.add_argument(x, **({"nargs": "+"} if x in ("rows", "folders") else {}))
        return p

    def settings(p: argparse.ArgumentParser) -> None:
        p.add_argument("--source", choices=sorted(RECIPES))
        for x in ("source-dataset", "source-revision", "dataset-version", "code-repository", "code-revision"):
            p.add_argument(f"--{x}")
        for x in ("threshold", "max-area-km2", "train", "validation", "test"):
            p.add_argument(f"--{x}", type=float)
        for x in ("least-words", "resolution", "seed"):
            p.add_argument(f"--{x}", type=int)

    p = command("build", "from sources and tiles to a promoted release", "sources", "tiles", "work", "out")
    settings(p)
    p.add_argument("--regions", nargs="*")
    p.add_argument("--regions-file")
    p = command("regions", "list the regions of a source", "sources")
    settings(p)
    p = command("assemble", "one release of the shards of several workers", "out", "folders")
    settings(p)
    p.add_argument("--expected-file")
    p.add_argument("--assembly-revision")
    p.add_argument("--without-receipts", action="store_true", help="take bare Parquet files; the release is marked as not publishable")
    p = command("verify", "check the guarantees of a release", "folder")
    p.add_argument("--threshold", type=float)
    p.add_argument("--least-words", type=int)
    p = command("audit", "check a release folder, or single Parquet files of published rows", "rows")
    for x in ("require-complete", "require-card", "strict-text"):
        p.add_argument(f"--{x}", action="store_true")
    command("validate", "check the guarantees of published rows", "rows")
    command("publish", "write the card, audit, copy and verify", "folder", "destination").add_argument("--allow-subset", action="store_true")
    command("info", "say what a release holds", "folder")
    command("migrate-release-lock", "make the lock of an older release", "folder")
    command("release", "deduplicate a table of examples and write ordered splits and a manifest", "table", "folder")
    command("query", "run a query over a folder of tables", "name", "folder").add_argument("--rows", type=int, default=20)
    return parser


def _say(found: list) -> int:
    for r in found:
        print(f"{r['code']}: {r['n']} ({', '.join(str(x) for x in r['samples'])})")
    return int(bool(found))


def _given(a: argparse.Namespace) -> dict:
    return {k: v for k in OPTIONS if (v := getattr(a, k, None)) is not None}


def _run(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.what == "build":
        regions = a.regions or (parse_regions(Path(a.regions_file).read_text()) if a.regions_file else None)
        done = run.run(spark, Settings.from_options(**_given(a)), a.sources, a.tiles, a.work, a.out, regions)
        print(json.dumps({k: v for k, v in done.items() if k != "manifest"} | {"examples": done["manifest"]["counts"]["examples"]}, indent=2))
    elif a.what == "regions":
        s = Settings.from_options(**_given(a))
        catalog = SourceCatalog(spark, a.sources, recipe_for(s.source))
        print("\n".join(catalog.regions(catalog.resolve_revision(s.source_revision or "main"))))
    elif a.what == "assemble":
        if a.without_receipts:
            done = run.gather(spark, a.folders, Settings.from_options(**_given(a)), a.out)
        else:
            given = Settings.from_options(**_given(a)).as_manifest()
            names = {"threshold": "dominance_threshold", "least_words": "min_words", "max_area_km2": "max_polygon_area_m2", "resolution": "h3_resolution", "seed": "split_seed"}
            asked = {names.get(k, k): given[names.get(k, k)] for k in _given(a) if names.get(k, k) in given and k not in ("dataset_version", "code_repository")}
            expected = parse_regions(Path(a.expected_file).read_text()) if a.expected_file else None
            done = run.assemble(spark, a.folders, a.out, expected, asked, a.assembly_revision, a.dataset_version)
        print(json.dumps({"target": done["target"], "changed": done["changed"]}, indent=2))
    elif a.what == "verify":
        m = auditing.load_manifest(Path(a.folder))
        limit = run.verify_threshold(a.threshold, m, THRESHOLD)
        least = a.least_words or (m or {}).get("settings", {}).get("min_words") or MIN_WORDS
        rows = spark.read.parquet(*(f"{a.folder}/{n}.parquet" for n in checks.SPLIT_NAMES))
        return _say(checks.report(checks.release_violations(rows, limit, least)).orderBy("code").collect())
    elif a.what == "audit" and len(a.rows) == 1 and os.path.exists(f"{a.rows[0]}/manifest.json"):
        found = auditing.audit(spark, a.rows[0], a.require_complete, a.require_card, a.strict_text).collect()
        _say(found)
        return int(any(r["severity"] == "error" for r in found))
    elif a.what in ("audit", "validate"):
        rows = spark.read.parquet(*a.rows)
        return _say(checks.report(checks.release_violations(rows) if a.what == "validate" else checks.audit_violations(rows)).orderBy("code").collect())
    elif a.what == "publish":
        print(json.dumps(publish.publish(spark, Path(a.folder), Path(a.destination), not a.allow_subset), indent=2))
    elif a.what == "info":
        m = auditing.load_manifest(Path(a.folder))
        if m is None:
            raise ValueError(f"no manifest in {a.folder}")
        print(json.dumps({"counts": m["counts"], "classes": m["class_distribution"], "languages": m["language_distribution"][:10], "settings": m["settings"]}, indent=2, ensure_ascii=False))
    elif a.what == "migrate-release-lock":
        print(locks.initialise_lock(Path(a.folder)))
    elif a.what == "release":
        print(json.dumps(release.build(spark, spark.read.parquet(a.table), a.folder), indent=2, default=str))
    else:
        from .queries import QUERIES

        QUERIES[a.name](spark, a.folder).show(a.rows, truncate=False)
    return 0


def main(argv: list[str] | None = None) -> int:
    """0 where all is well, 1 where a check found something or the call failed; an error is one line."""
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("cartolex").getOrCreate()
    try:
        return _run(spark, a)
    except (KeyError, OSError, ValueError) as error:
        print(f"error: {error}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
