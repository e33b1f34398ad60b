"""Inventories of regions, totals of outcomes and their accounting identities."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a file that a task holds at once.
CHUNK = 1 << 20


def gaps(expected: DataFrame, processed: DataFrame, key: str = "stem") -> DataFrame:
    """Expected keys that were not processed."""
    return expected.select(key).distinct().join(processed.select(key), key, "left_anti")


def overlap(a: DataFrame, b: DataFrame, key: str = "stem") -> DataFrame:
    return a.select(key).intersect(b.select(key))


def equal(a: DataFrame, b: DataFrame, key: str = "stem") -> DataFrame:
    """(only_a, only_b, same): how many keys either side has alone, copies counted, and whether none."""
    left, right = a.select(key), b.select(key)
    one = left.exceptAll(right).agg(F.count("*").alias("only_a"))
    two = right.exceptAll(left).agg(F.count("*").alias("only_b"))
    return one.join(two).withColumn("same", (F.col("only_a") == 0) & (F.col("only_b") == 0))


def merge_counts(rows: DataFrame, column: str) -> DataFrame:
    """(reason, n): a map column of counts, summed by key."""
    return rows.select(F.explode(column).alias("reason", "k")).groupBy("reason").agg(F.sum("k").alias("n"))


def totals(outcomes: DataFrame, counts: tuple[str, ...], maps: tuple[str, ...] = ("rejections", "text_rejections"), tiles: str = "tiles_missing") -> DataFrame:
    """One row: the sums of the count columns, the maps merged by key, and the distinct tiles in order.

    Keys of the maps are reasons, a handful; tiles are at most those of the globe.
    """
    out = outcomes.agg(*[F.sum(c).alias(c) for c in counts], F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array_distinct(tiles))))).alias(tiles))
    for m in maps:
        out = out.join(F.broadcast(merge_counts(outcomes, m).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias(m))))
    return out


def union_keys(*inventories: DataFrame, key: str = "stem") -> DataFrame:
    """Keys that any inventory names."""
    out = inventories[0].select(key)
    for i in inventories[1:]:
        out = out.union(i.select(key))
    return out.distinct()


def reconcile(outcomes: DataFrame) -> DataFrame:
    """Outcomes with whether seen = invalid + accepted + rejected, and accepted = with examples + lost texts."""
    return outcomes.withColumns({
        "polygons_balance": F.col("polygons_seen") == F.col("polygons_invalid") + F.col("polygons_accepted") + F.col("rejected"),
        "texts_balance": F.col("polygons_accepted") == F.col("polygons_with_examples") + F.col("text_rejected"),
    })


def provenance_groups(rows: DataFrame, revision: str = "revision", key: str = "stem") -> DataFrame:
    """(revision, stems): sorted keys by revision."""
    return rows.select(revision, key).distinct().groupBy(revision).agg(F.array_sort(F.collect_list(key)).alias("stems"))


def _sha256(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for path in b.column("full").to_pylist():
            scheme, rest = path.split(":", 1)
            system, at = (fs.LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else fs.FileSystem.from_uri(path)
            h = hashlib.sha256()
            with system.open_input_stream(at, compression=None) as f:
                while chunk := f.read(CHUNK):
                    h.update(chunk)
            out.append(h.hexdigest())
        yield pa.record_batch({"path": b.column("path"), "length": b.column("length"), "sha256": pa.array(out, pa.string())})


def file_digests(spark: SparkSession, folder: str, names: str = "*.parquet") -> DataFrame:
    """(path, length, sha256): every file under `folder` whose name matches, by its path in the folder.

    Contents stream through the hash in chunks, so a file may be larger than a cell or a task's memory; each file is
    read by one task.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString()
    found = spark.read.format("binaryFile").option("pathGlobFilter", names).option("recursiveFileLookup", "true").load(folder)
    paths = found.select(F.col("path").alias("full"), F.expr(f"substring(path, {len(root.rstrip('/')) + 2})").alias("path"), "length")
    return paths.mapInArrow(_sha256, "path string, length long, sha256 string")
