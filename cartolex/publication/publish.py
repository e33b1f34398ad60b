"""Publication of a release to a folder: audited, copied, read back, and a receipt that says so."""

from __future__ import annotations

import shutil
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

from ..operators import summary
from .audit import audit, load_manifest, read_release
from .card import MAP, write_card
from .locks import read_lock, write_lock
from .promotion import CORE
from .storage import inventory, sync_folder, write_atomic, write_json

CHECKSUMS, RECEIPT = "checksums.sha256", "publication.json"
SIDECARS = ("README.md", MAP)


def checksums(files: dict[str, dict]) -> str:
    """Lines of digest and name, in order of name, as public tools read them."""
    return "".join(f"{v['sha256']}  {k}\n" for k, v in sorted(files.items()))


def parse_checksums(text: str) -> dict[str, str]:
    out = {}
    for line in text.splitlines():
        digest, _, name = line.partition("  ")
        if len(digest) != 64 or not name or name in out:
            raise ValueError(f"not a checksum: {line!r}")
        out[name] = digest
    return out


def prepare(spark: SparkSession, folder: Path) -> dict:
    """Write the card, the map and the checksums beside a release; its manifest."""
    folder = Path(folder)
    with write_lock(folder):
        m = load_manifest(folder)
        rows, bad = read_release(spark, folder)
        if m is None or rows is None:
            raise ValueError(f"no release that can be read: {bad}")
        write_card(folder, m, summary.centroids(rows, refuse=True))
        write_atomic(folder / CHECKSUMS, checksums({k: v for k, v in inventory(folder).items() if k.split("/")[0] in (*CORE, *SIDECARS)}))
        return m


def publish(spark: SparkSession, folder: Path, destination: Path, require_complete: bool = True) -> dict:
    """Audit a release with its card and copy it to `destination`, a new folder; the receipt that is written in both.

    Everything is copied under another name, read back against the checksums and renamed at last, so a reader finds the
    whole release or none.
    """
    folder, destination = Path(folder), Path(destination)
    prepare(spark, folder)
    with read_lock(folder):
        errors = [r["code"] for r in audit(spark, folder, require_complete, True).where("severity = 'error'").collect()]
        if errors:
            raise ValueError(f"the audit refuses the release: {sorted(errors)}")
        if destination.exists():
            raise ValueError(f"{destination} exists")
        wanted = parse_checksums((folder / CHECKSUMS).read_text(encoding="utf-8"))
        part = destination.with_name(f".{destination.name}.part-{uuid.uuid4().hex}")
        part.mkdir(parents=True)
        try:
            for name in (*wanted, CHECKSUMS):
                (part / name).parent.mkdir(exist_ok=True)
                shutil.copyfile(folder / name, part / name)
            receipt = verify(part) | {"destination": str(destination)}
            write_json(part / RECEIPT, receipt, indent=2)
            sync_folder(part)
            part.rename(destination)
        finally:
            if part.exists():
                shutil.rmtree(part)
        sync_folder(destination.parent)
    with write_lock(folder):
        write_json(folder / RECEIPT, receipt, indent=2)
    return receipt


def verify(folder: Path) -> dict:
    """What a published folder holds, by size and hash; ValueError where it differs from its checksums."""
    files = inventory(folder)
    wanted = parse_checksums((Path(folder) / CHECKSUMS).read_text(encoding="utf-8"))
    for must in (*CORE, *SIDECARS):
        if must not in {k.split("/")[0] for k in wanted}:
            raise ValueError(f"no checksum of {must}")
    if wrong := sorted(k for k, v in wanted.items() if files.get(k, {}).get("sha256") != v):
        raise ValueError(f"files differ from their checksums: {wrong}")
    return {"version": 1, "files": {k: files[k] for k in sorted(wanted)}}
