"""Small files of a release: canonical JSON, fingerprints, atomic writes and inventories of folders.

These handle a fixed number of small driver-side files; tables are written and read by Spark.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import stat
import uuid
from pathlib import Path

CHUNK = 1 << 20


def canonical_json(value: object) -> str:
    """One text per value: sorted keys, no spaces, no NaN or infinity."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def fingerprint(value: object) -> str:
    """SHA-256 of the canonical JSON of a value."""
    return hashlib.sha256(canonical_json(value).encode()).hexdigest()


def sync_folder(folder: Path) -> None:
    handle = os.open(folder, os.O_RDONLY | os.O_DIRECTORY)
    try:
        os.fsync(handle)
    finally:
        os.close(handle)


def write_atomic(path: Path, text: str) -> None:
    """Readers see the old file or the whole new one: temporary file, fsync, rename, fsync of the folder."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f".{path.name}.{uuid.uuid4().hex}.tmp")
    try:
        with open(part, "x", encoding="utf-8") as f:
            f.write(text)
            f.flush()
            os.fsync(f.fileno())
        os.replace(part, path)
    finally:
        part.unlink(missing_ok=True)
    sync_folder(path.parent)


def write_json(path: Path, value: object, indent: int | None = None) -> None:
    """Canonical JSON, or indented JSON in the order given, written atomically."""
    write_atomic(path, canonical_json(value) if indent is None else json.dumps(value, indent=indent, ensure_ascii=False, allow_nan=False) + "\n")


def file_sha256(path: Path) -> str:
    """Digest of a regular file; refused where the file changes while it is read."""
    with open(path, "rb") as f:
        before = os.fstat(f.fileno())
        digest = hashlib.sha256()
        while chunk := f.read(CHUNK):
            digest.update(chunk)
        after = os.fstat(f.fileno())
    if (before.st_size, before.st_mtime_ns, before.st_ino) != (after.st_size, after.st_mtime_ns, after.st_ino):
        raise OSError(f"changed while it was hashed: {path}")
    return digest.hexdigest()


def inventory(folder: Path, names: tuple[str, ...] | None = None) -> dict[str, dict]:
    """{name: {bytes, sha256}} of the regular files in a folder; links, devices and other subfolders are refused.

    A table may be one file `x.parquet` or a folder of that name with files, which are then `x.parquet/file`. With
    `names`, exactly these files or tables must be there.
    """
    out = {}
    for entry in sorted(Path(folder).iterdir()):
        table = stat.S_ISDIR(entry.lstat().st_mode) and entry.suffix == ".parquet"
        for file in sorted(entry.iterdir()) if table else [entry]:
            if not stat.S_ISREG(file.lstat().st_mode):
                raise ValueError(f"not a regular file: {file}")
            out[str(file.relative_to(folder))] = {"bytes": file.stat().st_size, "sha256": file_sha256(file)}
    if names is not None and {k.split("/")[0] for k in out} != set(names):
        raise ValueError(f"wanted {sorted(names)}, found {sorted(out)} in {folder}")
    return out


def clear_marks(folder: Path) -> None:
    """Remove what writers leave beside data, marks of success and checksums of single files, and name parts by their number alone.

    Writers name parts by a random number too; without it the same rows give the same inventory.
    """
    for entry in Path(folder).iterdir():
        for file in list(entry.iterdir()) if entry.is_dir() else [entry]:
            if file.name.startswith(("_", ".")):
                file.unlink()
            elif entry.is_dir() and (m := re.match(r"part-(\d+)-.*\.parquet$", file.name)):
                file.rename(entry / f"part-{m[1]}.parquet")
