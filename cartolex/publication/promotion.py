"""Promotion of a staged release: a journal, two renames, and a recovery that never guesses.

A release `v<version>` is replaced by renaming it to a backup and the stage to its place. The journal is written before
and removed after; whatever a crash leaves is told by which folders equal which inventory of the journal.
"""

from __future__ import annotations

import json
import os
import re
import shutil
import uuid
from dataclasses import asdict, dataclass, replace
from pathlib import Path

from .locks import write_lock
from .storage import inventory, sync_folder, write_json

#: Files of a release that promotion moves; all else beside them is a sidecar.
CORE = ("train.parquet", "validation.parquet", "test.parquet", "manifest.json")
VERSION = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]{0,63}\Z")
HEX = re.compile(r"[0-9a-f]{64}\Z")


def target_path(root: Path, version: str) -> Path:
    if not VERSION.match(version) or ".." in version:
        raise ValueError(f"not a version that may name a folder: {version!r}")
    return Path(root) / f"v{version}"


def journal_path(target: Path) -> Path:
    return Path(target).with_name(f".{Path(target).name}.transaction.json")


def new_stage(target: Path) -> Path:
    """An empty folder beside the target."""
    stage = Path(target).with_name(f".{Path(target).name}.stage-{uuid.uuid4().hex}")
    stage.mkdir(parents=True)
    return stage


def _is_name(target: Path, name: str, kind: str) -> bool:
    return re.fullmatch(rf"{re.escape(f'.{target.name}.{kind}-')}[0-9a-f]{{32}}", name) is not None


@dataclass(frozen=True)
class Journal:
    """What a promotion replaces by what."""

    version: int
    target: str
    stage: str
    backup: str
    old: dict | None
    new: dict
    cleanup_stage: bool = False

    def save(self, path: Path) -> None:
        write_json(path, asdict(self))

    @staticmethod
    def load(target: Path) -> Journal:
        """Exactly the known fields, names that belong to the target, and whole digests; anything else is an error."""
        data = json.loads(journal_path(target).read_text(encoding="utf-8"))
        if not isinstance(data, dict) or set(data) != set(Journal.__dataclass_fields__) or data["version"] != 1 or data["target"] != Path(target).name:
            raise ValueError(f"journal of another shape: {journal_path(target)}")
        if not _is_name(Path(target), data["stage"], "stage") or not _is_name(Path(target), data["backup"], "backup") or not isinstance(data["cleanup_stage"], bool):
            raise ValueError("journal names other folders")
        for kept in (data["old"] or {}, data["new"]):
            for name, file in kept.items():
                if name.count("/") > 1 or ".." in name or set(file) != {"bytes", "sha256"} or not isinstance(file["bytes"], int) or not HEX.match(file["sha256"]):
                    raise ValueError("journal with a broken inventory")
        if {k.split("/")[0] for k in data["new"]} != set(CORE):
            raise ValueError("journal without the core files")
        return Journal(**data)


def _core(folder: Path) -> dict:
    return {k: v for k, v in inventory(folder).items() if k.split("/")[0] in CORE}


def _sync(folder: Path) -> None:
    for f in Path(folder).rglob("*"):
        handle = os.open(f, os.O_RDONLY)
        try:
            os.fsync(handle)
        finally:
            os.close(handle)
    sync_folder(folder)


def promote(stage: Path, target: Path) -> bool:
    """Put a stage of exactly the core files in the place of the target; False where both are equal already.

    An unchanged release keeps its sidecars and the stage is dropped; a changed one is replaced as a whole.
    """
    stage, target = Path(stage), Path(target)
    if not _is_name(target, stage.name, "stage") or stage.parent != target.parent:
        raise ValueError(f"{stage} is no stage of {target}")
    with write_lock(target):
        recover(target, keep=stage.name)
        _sync(stage)
        new = inventory(stage, CORE)
        old = _core(target) if target.exists() else None
        if old == new:
            shutil.rmtree(stage)
            return False
        path = journal_path(target)
        if path.exists():
            raise RuntimeError(f"another promotion is pending: {path}")
        journal = Journal(1, target.name, stage.name, f".{target.name}.backup-{uuid.uuid4().hex}", old, new)
        journal.save(path)
        if old is not None:
            os.rename(target, target.parent / journal.backup)
            sync_folder(target.parent)
            if _core(target.parent / journal.backup) != old:
                raise RuntimeError("the old release changed while it was moved")
        if inventory(stage, CORE) != new:
            raise RuntimeError("the stage changed while it was promoted")
        os.rename(stage, target)
        sync_folder(target.parent)
        if _core(target) != new:
            raise RuntimeError("the promoted release is not the staged one")
        _finish(target, journal)
        return True


def state(target: Path, journal: Journal) -> str:
    """Which step a promotion reached; an error where what is there fits none."""
    parent = Path(target).parent
    stage, backup = parent / journal.stage, parent / journal.backup
    at = _core(target) if Path(target).exists() else None
    kept = _core(backup) if backup.exists() else None
    staged = _core(stage) if stage.exists() else None
    partly = staged is not None and all(journal.new.get(k) == v for k, v in staged.items())
    stage_ok = staged == journal.new or journal.cleanup_stage and (staged is None or partly)
    if at == journal.new and staged is None and (journal.old is None and kept is None or journal.old is not None and kept in (None, journal.old)):
        return "committed"
    if journal.old is not None and at == journal.old and kept is None and stage_ok:
        return "old-at-target"
    if journal.old is not None and at is None and kept == journal.old and stage_ok:
        return "old-at-backup"
    if journal.old is None and at is None and kept is None and staged == journal.new:
        return "no-old-stage"
    if journal.old is None and at is None and kept is None and journal.cleanup_stage and (staged is None or partly):
        return "no-old-cleanup-complete"
    raise RuntimeError(f"the folders beside {target} fit no step of its journal; nothing was changed")


def _drop_stage(target: Path, journal: Journal) -> None:
    """A half-deleted stage still counts as one, since the journal says first that it is being deleted."""
    stage = Path(target).parent / journal.stage
    if not journal.cleanup_stage:
        journal = replace(journal, cleanup_stage=True)
        journal.save(journal_path(target))
    if stage.exists():
        shutil.rmtree(stage)
    sync_folder(stage.parent)


def _finish(target: Path, journal: Journal) -> None:
    backup = Path(target).parent / journal.backup
    if backup.exists():
        shutil.rmtree(backup)
        sync_folder(backup.parent)
    journal_path(target).unlink()
    sync_folder(Path(target).parent)


def recover(target: Path, keep: str | None = None) -> str | None:
    """Settle what a crash left: the new release where it stands, else the old one. The state found, or None.

    Stages and temporary journals that no journal names are removed; a backup without a journal is an error, as it may be
    the only copy of a release.
    """
    target = Path(target)
    with write_lock(target):
        found = None
        if journal_path(target).exists():
            journal = Journal.load(target)
            found = state(target, journal)
            if found == "old-at-backup":
                os.rename(target.parent / journal.backup, target)
                sync_folder(target.parent)
            if found != "committed":
                _drop_stage(target, journal)
            _finish(target, journal)
        for entry in list(target.parent.iterdir()) if target.parent.exists() else []:
            if _is_name(target, entry.name, "backup"):
                raise RuntimeError(f"a backup without a journal: {entry}")
            if entry.name != keep and _is_name(target, entry.name, "stage"):
                shutil.rmtree(entry)
            elif re.fullmatch(rf"\.{re.escape(journal_path(target).name)}\.[0-9a-f]{{32}}\.tmp", entry.name):
                entry.unlink()
        return found
