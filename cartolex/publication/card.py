"""The card of a release: Markdown made from the manifest alone, a map of its polygons, and what a reader may check in it."""

from __future__ import annotations

import struct
import zlib
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CLASSES, NULLABLE, RELEASE, SPLITS
from .storage import write_atomic

MAP = "worldcover_centroids.png"
# Colours of the land-cover classes.
COLOURS = {10: "006400", 20: "ffbb22", 30: "ffff4c", 40: "f096ff", 50: "fa0000", 60: "b4b4b4", 70: "f0f0f0", 80: "0064c8", 90: "0096a0", 95: "00cf75", 100: "fae6a0"}


def cell(value: object) -> str:
    """A value as a table cell: bars and line ends would break the row; whole numbers in groups of three digits."""
    if value is None:
        return ""
    if isinstance(value, int) and not isinstance(value, bool):
        return f"{value:,}"
    return str(value).replace("\\", "\\\\").replace("|", "\\|").replace("\r", " ").replace("\n", " ")


def table(head: tuple[str, ...], rows: list[tuple]) -> str:
    return "\n".join(f"| {' | '.join(map(cell, r))} |" for r in (head, ("---",) * len(head), *rows)) + "\n"


def front_matter(license_name: str) -> str:
    files = "".join(f"\n      - split: {n}\n        path: {n}.parquet" for n, _ in SPLITS)
    return f"---\nlicense: {license_name}\nlanguage:\n  - multilingual\ntask_categories:\n  - text-classification\nconfigs:\n  - config_name: default\n    data_files:{files}\n---\n"


def code_group(group: dict) -> str:
    n = len(group["regions"])
    return f"[{group['revision']}]({group['repository']}/tree/{group['revision']}) — {n:,} region{'' if n == 1 else 's'}"


def render(m: dict) -> str:
    """The card of a manifest; the same manifest gives the same text."""
    s, counts, percent = m["settings"], m["counts"], lambda x: f"{x * 100:.1f}%"
    parts = [
        front_matter(s.get("dataset_license", "cc-by-sa-4.0")), f"# Text and land cover, version {s.get('dataset_version', '')}\n",
        f"Each example pairs {s.get('source_text_description', 'a text')} with the land-cover class of at least {round(100 * s.get('dominance_threshold', 0.8))}% of the polygon it is about: "
        f"**{counts['examples']['total']:,} examples** of {counts['polygons']['total']:,} polygons and {counts['documents']['total']:,} documents.\n",
        f"![Polygons by class]({MAP})\n", "## Splits\n\n" + table(("split", "examples", "polygons", "documents"), [(k, *(counts[c][k] for c in ("examples", "polygons", "documents"))) for k in (*(n for n, _ in SPLITS), "total")]),
        "## Classes\n\n" + table(("code", "class", "examples", "share"), [(str(x["code"]), x["label"], x["examples"], percent(x["share"])) for x in m["class_distribution"]]),
        "## Languages\n\n" + table(("language", "examples", "share"), [(x["language"] or "(unspecified)", x["examples"], percent(x["share"])) for x in m["language_distribution"][:15]]),
    ]
    if m.get("example_polygons"):
        parts.append("## Named polygons\n\n" + table(("class", "name"), [(x["worldcover_label"], x["name"]) for x in m["example_polygons"]]))
    g = m["geographic_coverage"]
    parts.append(f"## Extent\n\n{g['h3_cells']:,} cells in {g['regions']:,} regions; longitude {g['bbox']['min_lon']} to {g['bbox']['max_lon']}, latitude {g['bbox']['min_lat']} to {g['bbox']['max_lat']}.\n")
    parts.append("## Columns\n\n" + table(("column", "type", "null"), [(f.name, f.dataType.simpleString(), "may be" if f.name in NULLABLE else "never") for f in RELEASE.fields]))
    for title, key in (("Refused polygons", "rejections"), ("Removed records", "deduplication")):
        if m.get(key):
            parts.append(f"## {title}\n\n" + table(("reason", "rows"), sorted(m[key].items())))
    parts.append(f"## Provenance\n\nSource {s.get('source_dataset')} at revision {s.get('source_revision')}; land cover {s.get('worldcover_version')} of {s.get('worldcover_year')}; splits by cells of resolution {s.get('h3_resolution')} under seed {s.get('split_seed')}.\n")
    book = m.get("processing", {})
    parts += [f"- regions by code {code_group(x)}\n" for x in book.get("code_provenance", [])]
    if book.get("assembly_code_revision"):
        parts.append(f"- assembled by code [{book['assembly_code_revision']}]\n")
    return "\n".join(parts)


def png(pixels: np.ndarray) -> bytes:
    """A PNG of (height, width, 3) bytes."""
    h, w, _ = pixels.shape
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    raw = np.hstack((np.zeros((h, 1), np.uint8), pixels.reshape(h, w * 3))).tobytes()
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw, 9)) + part(b"IEND", b"")


def centroid_map(points: DataFrame, width: int = 1440) -> np.ndarray:
    """Pixels of a map in plate carrée: each shows the most frequent class of its polygons, the lowest code at ties.

    Points are counted by pixel and class where they are; the driver gets at most one row per pixel.
    """
    height = width // 2
    x = F.least(F.floor((F.col("lon") + 180) / 360 * width), F.lit(width - 1)).cast("int")
    y = F.least(F.floor((90 - F.col("lat")) / 180 * height), F.lit(height - 1)).cast("int")
    by = points.where("lat between -90 and 90 and lon between -180 and 180").groupBy(x.alias("x"), y.alias("y"), "worldcover_code").agg(F.count("*").alias("n"))
    out = np.full((height, width, 3), 255, np.uint8)
    for r in by.groupBy("x", "y").agg(F.min(F.struct((-F.col("n")).alias("n"), "worldcover_code"))["worldcover_code"].alias("c")).collect():
        out[r["y"], r["x"]] = tuple(bytes.fromhex(COLOURS.get(r["c"], "000000")))
    return out


def write_card(folder: Path, m: dict, points: DataFrame) -> None:
    """README.md and the map beside a release."""
    folder = Path(folder)
    part = folder / f".{MAP}.part"
    part.write_bytes(png(centroid_map(points)))
    part.replace(folder / MAP)
    write_atomic(folder / "README.md", render(m))


def _front(text: str) -> dict[str, object]:
    """The license and the (split, path) pairs of a card's front matter."""
    if not text.startswith("---"):
        raise ValueError("no front matter")
    head = text.split("---", 2)[1]
    pairs, license_name, split = [], None, None
    for line in head.splitlines():
        key, _, value = line.strip().removeprefix("- ").partition(":")
        if key == "license":
            license_name = value.strip()
        elif key == "split":
            split = value.strip()
        elif key == "path":
            pairs.append((split, value.strip()))
    return {"license": license_name, "files": pairs}


def card_problems(folder: Path, settings: dict, processing: dict) -> list[tuple[str, list[str]]]:
    """(code, samples) of what is wrong with a release's card or map."""
    out: list[tuple[str, list[str]]] = []
    try:
        text = (Path(folder) / "README.md").read_text(encoding="utf-8")
        front = _front(text)
        if front["files"] != [(n, f"{n}.parquet") for n, _ in SPLITS]:
            out.append(("card_data_files_mismatch", []))
        if front["license"] != settings.get("dataset_license", "cc-by-sa-4.0"):
            out.append(("card_license_mismatch", [str(front["license"])]))
        out += [(f"card_missing_provenance:{k}", []) for k in ("source_revision", "source_dataset") if str(settings.get(k)) not in text]
        if MAP not in text:
            out.append(("card_missing_coverage_map", []))
        if (Path(folder) / MAP).read_bytes()[:8] != b"\x89PNG\r\n\x1a\n":
            out.append(("invalid_coverage_map_png", []))
        out += [("card_missing_code_provenance", [g["revision"]]) for g in processing.get("code_provenance", []) if code_group(g) not in text]
        revision = processing.get("assembly_code_revision")
        if revision and f"[{revision}]" not in text:
            out.append(("card_missing_assembly_code_revision", [revision]))
    except (OSError, ValueError, KeyError, AttributeError) as error:
        out.append(("invalid_card_or_map", [str(error)]))
    return out


assert set(COLOURS) == set(CLASSES)
