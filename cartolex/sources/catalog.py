"""Where sources lie: revisions, region inventories and region files of a folder, and raster tiles with a bounded cache.

A source is a folder of the shared file system, of one revision or with a folder per revision. Nothing is fetched over a network.
"""

from __future__ import annotations

import re
import shutil
import uuid
from collections import OrderedDict
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .rasters import read_tile_files
from .readers import exists, stems
from .recipes import Recipe, Triple

REVISION = re.compile(r"[0-9a-f]{40}\Z")


def parse_regions(text: str) -> list[str]:
    """Region names, one a line; `#` begins a comment, blank lines do not count; repeated names count once, in order."""
    names = (line.split("#", 1)[0].strip() for line in text.splitlines())
    return list(dict.fromkeys(n for n in names if n))


class SourceCatalog:
    """A source's tables under `root`, or under `root/<revision>` where such folders are kept."""

    def __init__(self, spark: SparkSession, root: str, recipe: Recipe) -> None:
        self.spark, self.root, self.recipe = spark, root.rstrip("/"), recipe

    def resolve_revision(self, ref: str) -> str:
        """A full revision stands for itself; a name is looked up in `root/refs/<name>`, a file with the revision."""
        if REVISION.match(ref):
            return ref
        if not re.fullmatch(r"[\w.-]+", ref):
            raise ValueError(f"not the name of a revision: {ref!r}")
        path = f"{self.root}/refs/{ref}"
        if not exists(self.spark, path):
            raise KeyError(f"no revision named {ref!r}")
        found = self.spark.read.text(path, wholetext=True).first()[0].strip()
        if not REVISION.match(found):
            raise ValueError(f"{path} holds no full revision")
        return found

    def folder(self, revision: str) -> str:
        own = f"{self.root}/{revision}"
        return own if exists(self.spark, own) else self.root

    def regions(self, revision: str) -> list[str]:
        """Sorted names of the regions there are."""
        return stems(self.spark, f"{self.folder(revision)}/{self.recipe.inventory}")

    def region_files(self, revision: str, stem: str) -> list[str]:
        """The files of a region; only the first, which names it, must be there."""
        base = self.folder(revision)
        first = f"{base}/{self.recipe.inventory}/{stem}.parquet"
        if not exists(self.spark, first):
            raise FileNotFoundError(first)
        more = ("polygon_document_links", "wikipedia/documents", "wikivoyage/documents") if self.recipe.name == "wikidata" else ()
        return [first, *(p for p in (f"{base}/{f}/{stem}.parquet" for f in more) if exists(self.spark, p))]

    def load(self, revision: str, names: list[str]) -> Triple:
        """(polygons with stem, links, documents) of the named regions, read by the source's layout; one scan a table."""
        return self.recipe.load(self.spark, self.folder(revision), names)


class TileNotPublished(KeyError):
    """There is no such tile; others may be read."""


class TileSource:
    """Raster tiles of a folder, with a bounded cache of local copies for use by single tiles.

    `table` is how jobs read tiles: by a list of paths, each decoded where it is read. `ensure` and `discard` serve
    tools that want a file: the least recently used copies beyond `most` go.
    """

    def __init__(self, spark: SparkSession, folder: str, cache: str | None = None, most: int = 4) -> None:
        self.spark, self.folder, self.most = spark, folder.rstrip("/"), most
        self.cache = Path(cache) if cache else None
        self.kept: OrderedDict[str, Path] = OrderedDict()
        self.pinned: dict[str, int] = {}

    def published(self) -> dict[str, str]:
        """{tile name: path} of the folder: at most one for each tile of the globe."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return {}
        out = {}
        for f in fs.listStatus(p):
            name = f.getPath().getName()
            m = re.search(r"[NS]\d{2}[EW]\d{3}", name)
            if m and name.endswith(".tif"):
                out[m[0]] = f.getPath().toString()
        return dict(sorted(out.items()))

    def table(self, names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
        """(grids, raster) of the named tiles that are published, of all where no names are given."""
        known = self.published()
        return read_tile_files(self.spark, [p for n, p in known.items() if names is None or n in set(names)])

    def ensure(self, name: str) -> Path:
        """A local copy of a tile: copied under another name, checked for its length, then renamed."""
        if self.cache is None:
            raise ValueError("no cache folder")
        if name not in self.kept or not self.kept[name].exists():
            known = self.published()
            if name not in known:
                raise TileNotPublished(name)
            source = Path(known[name].removeprefix("file:"))
            self.cache.mkdir(parents=True, exist_ok=True)
            target, part = self.cache / source.name, self.cache / f".{source.name}.{uuid.uuid4().hex}.part"
            try:
                shutil.copyfile(source, part)
                if part.stat().st_size != source.stat().st_size:
                    raise OSError(f"{source}: copied {part.stat().st_size} of {source.stat().st_size} bytes")
                part.replace(target)
            finally:
                part.unlink(missing_ok=True)
            self.kept[name] = target
        self.kept.move_to_end(name)
        self.pinned[name] = self.pinned.get(name, 0) + 1
        self._trim()
        return self.kept[name]

    def discard(self, name: str) -> None:
        """The caller is done with a tile; its copy stays while there is room."""
        if self.pinned.get(name, 0) > 0:
            self.pinned[name] -= 1
        self._trim()

    def _trim(self) -> None:
        for name in list(self.kept):
            if len(self.kept) <= self.most:
                return
            if not self.pinned.get(name):
                self.kept.pop(name).unlink(missing_ok=True)
