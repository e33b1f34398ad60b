"""Locks of a release: shared for readers, exclusive for writers, re-entrant within a process."""

from __future__ import annotations

import fcntl
import os
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

_HELD: dict[tuple[str, int, int], list] = {}
_GUARD = threading.RLock()


def lock_path(target: Path) -> Path:
    target = Path(target)
    return target.with_name(f".{target.name}.lock")


def initialise_lock(target: Path) -> Path:
    """The lock file of a release, made where an older release has none."""
    path = lock_path(target)
    path.parent.mkdir(parents=True, exist_ok=True)
    os.close(os.open(path, os.O_CREAT | os.O_RDWR, 0o644))
    return path


@contextmanager
def _held(path: Path, exclusive: bool, create: bool, wait: bool) -> Iterator[None]:
    key = (str(Path(path).absolute()), os.getpid(), threading.get_ident())
    with _GUARD:
        mine = _HELD.get(key)
        if mine:
            if exclusive and not mine[1]:
                raise RuntimeError("a shared lock cannot become exclusive")
            mine[2] += 1
    if not mine:
        handle = os.open(path, os.O_RDWR | (os.O_CREAT if create else 0), 0o644)
        try:
            fcntl.flock(handle, (fcntl.LOCK_EX if exclusive else fcntl.LOCK_SH) | (0 if wait else fcntl.LOCK_NB))
        except BaseException:
            os.close(handle)
            raise
        with _GUARD:
            _HELD[key] = mine = [handle, exclusive, 1]
    try:
        yield
    finally:
        with _GUARD:
            mine[2] -= 1
            if not mine[2]:
                del _HELD[key]
                fcntl.flock(mine[0], fcntl.LOCK_UN)
                os.close(mine[0])


@contextmanager
def write_lock(target: Path, wait: bool = True) -> Iterator[None]:
    """Exclusive lock of a release; made where it is missing."""
    Path(target).parent.mkdir(parents=True, exist_ok=True)
    with _held(lock_path(target), True, True, wait):
        yield


@contextmanager
def read_lock(target: Path, wait: bool = True) -> Iterator[None]:
    """Shared lock of a release; refused while a promotion is pending, whose outcome only a writer may settle."""
    from .promotion import journal_path

    path = lock_path(target)
    if not path.exists():
        raise FileNotFoundError(f"no lock of the release, make one by migration: {path}")
    with _held(path, False, False, wait):
        if journal_path(target).exists():
            raise RuntimeError(f"a promotion of {target} is pending; a writer must recover it")
        yield


@contextmanager
def scratch_lock(folder: Path) -> Iterator[None]:
    """One process at a time in a working folder."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    with _held(Path(folder) / ".scratch.lock", True, True, False):
        yield
