"""Audit of a release folder: manifest, schemas, settings, books, card, every row and what rows show together.

The rows are read once for row checks and once, narrow, for the whole; the manifest is compared with aggregates that
are worked out again. Nothing of the build is trusted.
"""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks
from ..plans import release
from ..plans.build import POLICY
from ..schema import CLASSES, RELEASE, SPLITS
from .accounting import REVISION, ledger_problems
from .card import card_problems

SECTIONS = ("settings", "counts", "geographic_coverage", "dominant_fraction")
PROVENANCE = ("dataset_version", "source_dataset", "source_revision", "worldcover_version", "worldcover_year")
#: Codes that warn only, unless equal texts across splits are asked to be errors.
WARNINGS = ("identical_text_cross_split", "identical_text_conflicting_labels")
FOUND = "severity string, code string, n long, samples array<string>"

Problem = tuple[str, str, int, list[str]]


def load_manifest(folder: Path) -> dict | None:
    """The manifest, or None where it is missing, no JSON, or of another shape."""
    try:
        m = json.loads((Path(folder) / "manifest.json").read_text(encoding="utf-8"))
    except (OSError, ValueError):
        return None
    lists = ("class_distribution", "language_distribution")
    whole = isinstance(m, dict) and all(isinstance(m.get(k), dict) for k in SECTIONS) and all(isinstance(m.get(k, {}), dict) for k in ("processing", "deduplication_analysis"))
    return m if whole and all(isinstance(m.get(k), list) and all(isinstance(x, dict) and isinstance(x.get("examples"), int) for x in m[k]) for k in lists) else None


def settings_problems(s: dict) -> list[Problem]:
    """invalid_settings, unpinned_source_revision."""
    number = lambda v: isinstance(v, (int, float)) and not isinstance(v, bool)
    try:
        shares = s["split_ratios"]
        ok = set(shares) == {n for n, _ in SPLITS} and all(number(v) and 0 <= v <= 1 for v in shares.values()) and abs(sum(shares.values()) - 1) <= 1e-9
        ok = ok and number(s["dominance_threshold"]) and 0 <= s["dominance_threshold"] <= 1 and isinstance(s["min_words"], int) and s["min_words"] >= 1
        ok = ok and isinstance(s["h3_resolution"], int) and 0 <= s["h3_resolution"] <= 15 and isinstance(s["split_seed"], int)
        ok = ok and s.get("deduplication_policy", POLICY) == POLICY and all(k in s for k in PROVENANCE)
    except (KeyError, TypeError, AttributeError):
        ok = False
    out: list[Problem] = [] if ok else [("error", "invalid_settings", 1, [])]
    if not REVISION.match(str(s.get("source_revision"))):
        out.append(("error", "unpinned_source_revision", 1, [str(s.get("source_revision"))]))
    return out


def read_release(spark: SparkSession, folder: Path) -> tuple[DataFrame | None, list[Problem]]:
    """(rows with file_split, problems): the three files under the exact schema; names and types count, order does not."""
    wanted = {f.name: f.dataType for f in RELEASE.fields}
    out, bad = None, []
    for name, _ in SPLITS:
        path = Path(folder) / f"{name}.parquet"
        try:
            df = spark.read.parquet(str(path))
            have = {f.name: f.dataType for f in df.schema.fields if f.name != "example_id"}
        except Exception as error:  # whatever a reader says of a broken file
            bad.append(("error", "missing_or_invalid_parquet", 1, [f"{name}: {type(error).__name__}"]))
            continue
        if have != wanted:
            bad.append(("error", "schema_mismatch", 1, [f"{name}: {sorted(k for k in {*have, *wanted} if have.get(k) != wanted.get(k))}"]))
            continue
        one = df.select(*wanted).withColumn("file_split", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return (None if bad else out), bad


def manifest_problems(rows: DataFrame, m: dict) -> list[Problem]:
    """What the manifest says and the rows do not: counts, distributions, labels, shares, extent, quantiles, equal texts."""
    true = release.manifest(rows)
    out: list[Problem] = []
    add = lambda code, ok, what="": None if ok else out.append(("error", code, 1, [str(what)] if what != "" else []))
    for k in ("examples", "polygons", "documents"):
        add(f"manifest_count_mismatch:{k}", m["counts"].get(k) == true["counts"][k], true["counts"][k])
    total = true["counts"]["examples"]["total"]
    for section, key in (("class_distribution", "code"), ("language_distribution", "language")):
        said = {x.get(key): x["examples"] for x in m[section]}
        add(f"manifest_mismatch:{section}", said == {x[key]: x["examples"] for x in true[section]} and len(m[section]) == len(true[section]))
        add("manifest_share_mismatch", all(x.get("share") == (round(x["examples"] / total, 6) if total else 0) for x in m[section]))
    add("manifest_class_label_mismatch", all(CLASSES.get(x.get("code")) == x.get("label") for x in m["class_distribution"]))
    add("manifest_geographic_coverage_mismatch", m["geographic_coverage"] == true["geographic_coverage"], true["geographic_coverage"])
    add("manifest_quantile_mismatch", m["dominant_fraction"] == true["dominant_fraction"], true["dominant_fraction"])
    if m.get("deduplication_analysis"):
        kept = release.retained(rows)
        add("deduplication_analysis_mismatch:retained_text", all(m["deduplication_analysis"].get(k) == v for k, v in kept.items()))
    add("empty_dataset", total > 0)
    return out


def audit(spark: SparkSession, folder: str | Path, require_complete: bool = False, require_card: bool = False, strict_text: bool = False) -> DataFrame:
    """(severity, code, n, samples) of everything that is wrong with a release folder, errors first; empty where nothing is.

    A broken manifest or file ends the audit there, since nothing else can be told. `require_complete` asks for a
    ledger of the full source whose books add up, `require_card` for the card and its map, `strict_text` makes equal texts
    across splits an error.
    """
    folder = Path(folder)
    m = load_manifest(folder)
    found: list[Problem] = [] if m else [("error", "missing_or_invalid_manifest", 1, [])]
    rows, bad = read_release(spark, folder)
    found += bad
    if m is None or rows is None:
        return spark.createDataFrame(found, FOUND)
    s = m["settings"]
    wrong = settings_problems(s)
    found += wrong
    if require_complete:
        book = m.get("processing", {})
        if book.get("full_source_complete") is not True:
            found.append(("error", "source_processing_incomplete", 1, []))
        elif said := ledger_problems(book, m):
            found.append(("error", "invalid_processing_ledger", len(said), said[:5]))
    if require_card:
        found += [("error", c, 1, x) for c, x in card_problems(folder, s, m.get("processing", {}))]
    if any(code == "invalid_settings" for _, code, _, _ in wrong):
        return spark.createDataFrame(found, FOUND)
    limits = {
        "threshold": s["dominance_threshold"], "cap": s.get("max_polygon_area_m2") or float("inf"), "least": s["min_words"], "provenance": {k: s[k] for k in PROVENANCE}, "assignment": True,
        "seed": s["split_seed"], "resolution": s["h3_resolution"], "splits": tuple((n, s["split_ratios"][n]) for n, _ in SPLITS),
    }
    found += manifest_problems(rows, m)
    soft = WARNINGS[1:] if strict_text else WARNINGS
    seen = checks.report(checks.audit_violations(rows, limits).unionByName(checks.whole_violations(rows)))
    seen = seen.select(F.when(F.col("code").isin(*soft), "warning").otherwise("error").alias("severity"), "code", "n", "samples")
    return (spark.createDataFrame(found, FOUND).unionByName(seen) if found else seen).orderBy("severity", "code")
