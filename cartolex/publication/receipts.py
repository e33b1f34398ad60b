"""Shards of regions and their receipts: what is done, told by hashes and counts rather than by a file's presence.

All regions of a run are written by one job, a folder `stem=<name>` each. A region's receipt is written after its data and
names the build context, every file with size and hash, rows, columns and the region's outcome. A shard whose receipt does
not fit in all of that is not done.
"""

from __future__ import annotations

import json
import re
import shutil
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ledger import file_digests
from .storage import canonical_json, fingerprint, write_json

RECEIPT = 1
COUNTS = ("polygons_seen", "polygons_invalid", "polygons_accepted", "polygons_with_examples", "source_links", "source_documents", "examples")
MAPS = ("rejections", "text_rejections")
FIELDS = frozenset(("stem", *COUNTS, *MAPS, "tiles_missing"))
STEM = re.compile(r"[^/\\=\x00]+\Z")


def safe_stem(stem: str) -> str:
    if not isinstance(stem, str) or not STEM.match(stem) or stem in (".", "..") or stem.startswith((".", "_")):
        raise ValueError(f"unsafe region name: {stem!r}")
    return stem


def checked_outcome(record: dict) -> dict:
    """An outcome with exactly the known fields, whole counts and balanced books; maps sorted by reason."""
    if not isinstance(record, dict) or set(record) != FIELDS:
        raise ValueError(f"an outcome has the fields {sorted(FIELDS)}")
    whole = lambda v: isinstance(v, int) and not isinstance(v, bool) and v >= 0
    if not all(whole(record[k]) for k in COUNTS) or not all(isinstance(record[k], dict) and all(whole(v) for v in record[k].values()) for k in MAPS):
        raise ValueError(f"{record['stem']}: counts are whole numbers from 0")
    if record["polygons_seen"] != record["polygons_invalid"] + record["polygons_accepted"] + sum(record["rejections"].values()):
        raise ValueError(f"{record['stem']}: polygons do not add up")
    if record["polygons_accepted"] != record["polygons_with_examples"] + sum(record["text_rejections"].values()):
        raise ValueError(f"{record['stem']}: texts do not add up")
    if record["examples"] < record["polygons_with_examples"]:
        raise ValueError(f"{record['stem']}: fewer examples than polygons with examples")
    return {**record, **{k: dict(sorted(record[k].items())) for k in MAPS}, "tiles_missing": sorted(record["tiles_missing"])}


def outcome_records(outcomes: DataFrame) -> list[dict]:
    """Rows of outcomes as plain records, one per region: as many as there are source files."""
    return [checked_outcome({k: (dict(v) if k in MAPS else list(v) if k == "tiles_missing" else v) for k, v in r.asDict().items()}) for r in outcomes.select(*sorted(FIELDS)).collect()]


class ShardStore:
    """Shards of one build context in a folder."""

    def __init__(self, spark: SparkSession, folder: str | Path, context: dict[str, Any]) -> None:
        self.spark, self.folder, self.context = spark, Path(folder), json.loads(canonical_json(context))
        self.fingerprint = fingerprint(self.context)
        self.folder.mkdir(parents=True, exist_ok=True)

    def path(self, stem: str) -> Path:
        return self.folder / f"stem={safe_stem(stem)}"

    def receipt(self, stem: str) -> Path:
        return self.folder / f"{safe_stem(stem)}.complete.json"

    def write(self, examples: DataFrame, outcomes: list[dict]) -> None:
        """Replace the shards of the outcomes' regions by the rows of `examples` (with column stem), then write the receipts.

        Old receipts go first and new ones come last, so a crash leaves regions that are not done, never wrong ones. A
        region without examples has a receipt and no files. Regions are gathered by a rebalance, which splits large ones.
        """
        outcomes = [checked_outcome(o) for o in outcomes]
        stems = {safe_stem(o["stem"]) for o in outcomes}
        if len(stems) != len(outcomes):
            raise ValueError("a region has two outcomes")
        for stem in stems:
            self.receipt(stem).unlink(missing_ok=True)
            if self.path(stem).exists():
                shutil.rmtree(self.path(stem))
        (
            examples.hint("rebalance", "stem").sortWithinPartitions("stem", "polygon_id", "document_id").write.mode("append")
            .partitionBy("stem").option("compression", "zstd").parquet(str(self.folder))
        )
        files, rows = self._files(), self._rows(sorted(stems))
        columns = [c for c in examples.columns if c != "stem"]
        for o in outcomes:
            n, polygons = rows.get(o["stem"], (0, 0))
            if (n, polygons) != (o["examples"], o["polygons_with_examples"]):
                raise ValueError(f"{o['stem']}: shard of {n} rows and {polygons} polygons, outcome of {o['examples']} and {o['polygons_with_examples']}")
            shard = {"files": files.get(o["stem"], {}), "rows": n, "columns": columns}
            write_json(self.receipt(o["stem"]), {"version": RECEIPT, "context_sha256": self.fingerprint, "context": self.context, "shard": shard, "outcome": o})

    def _files(self) -> dict[str, dict]:
        """{stem: {file: {bytes, sha256}}} of all data files; hashed where they are read, one task a file."""
        out: dict[str, dict] = {}
        if not any(self.folder.glob("stem=*/*.parquet")):
            return out
        for r in file_digests(self.spark, str(self.folder)).collect():
            stem, name = r["path"].split("/", 1)
            if stem.startswith("stem="):
                out.setdefault(stem[5:], {})[name] = {"bytes": r["length"], "sha256": r["sha256"]}
        return out

    def _rows(self, stems: list[str]) -> dict[str, tuple[int, int]]:
        """{stem: (rows, distinct polygons)} as read from the shards."""
        paths = [str(self.path(s)) for s in stems if self.path(s).exists()]
        if not paths:
            return {}
        df = self.spark.read.option("basePath", str(self.folder)).parquet(*paths)
        by = df.groupBy(F.col("stem").cast("string").alias("stem")).agg(F.count("*").alias("n"), F.countDistinct("polygon_id").alias("p"))
        return {r["stem"]: (r["n"], r["p"]) for r in by.collect()}

    def verified(self, stems: list[str] | None = None) -> dict[str, dict]:
        """{stem: outcome} of the regions that are done: context, files, sizes, hashes, rows and columns all fit the receipt."""
        stems = sorted(p.name.removesuffix(".complete.json") for p in self.folder.glob("*.complete.json")) if stems is None else stems
        files, out, checked = self._files(), {}, {}
        for stem in stems:
            try:
                r = json.loads(self.receipt(stem).read_text(encoding="utf-8"))
                if r["version"] != RECEIPT or r["context_sha256"] != self.fingerprint or r["context"] != self.context:
                    continue
                o = checked_outcome(r["outcome"])
                if r["shard"]["files"] != files.get(stem, {}) or o["stem"] != stem or o["examples"] != r["shard"]["rows"]:
                    continue
                checked[stem] = (r["shard"], o)
            except (OSError, ValueError, KeyError, TypeError, AttributeError):
                continue
        rows = self._rows([s for s, (shard, _) in checked.items() if shard["files"]])
        for stem, (shard, o) in checked.items():
            if rows.get(stem, (0, 0))[0] == shard["rows"] and (not shard["files"] or self._columns(stem) == sorted(shard["columns"])):
                out[stem] = o
        return out

    def _columns(self, stem: str) -> list[str]:
        return sorted(self.spark.read.parquet(str(self.path(stem))).columns)

    def outcome(self, stem: str) -> dict | None:
        return self.verified([stem]).get(stem)

    def has(self, stem: str) -> bool:
        return self.outcome(stem) is not None

    def stage(self, stems: list[str]) -> list[str]:
        """The folders of exactly these regions, all of them verified; an error names the others."""
        done = self.verified(stems)
        if missing := sorted(set(stems) - set(done)):
            raise ValueError(f"missing or unverifiable receipts: {missing}")
        return [str(self.path(s)) for s in sorted(done) if done[s]["examples"]]

    def read(self, stems: list[str]) -> DataFrame | None:
        """The rows of verified regions with their stem; None where they have none."""
        paths = self.stage(stems)
        return self.spark.read.option("basePath", str(self.folder)).parquet(*paths).withColumn("stem", F.col("stem").cast("string")) if paths else None

    def rejections(self, stems: list[str]) -> dict[str, int]:
        """Reasons of refused polygons, summed over regions."""
        total: dict[str, int] = {}
        for o in self.verified(stems).values():
            for k, n in o["rejections"].items():
                total[k] = total.get(k, 0) + n
        return dict(sorted(total.items()))
