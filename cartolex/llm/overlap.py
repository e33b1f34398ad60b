"""Problem 3: records of evaluation splits that recur, exactly or almost, in the training split.

A suffix array over all distinct texts, in order of the leading RUN words of a suffix. Every suffix that begins a run of
RUN words its text has not begun before is written once, dealt to range partitions of that order and sorted there; a
partition is read as a stream, and suffixes whose neighbours of the other side have a common prefix of RUN words or more
stay. A longer shared span is a chain of such suffixes at consecutive words, so no deeper comparison is needed to merge
spans into the coverage of a record. Records covered by less than the wanted share are out; the others meet in the
suffixes with the fewest neighbours (the prefix principle of set joins, which loses no pair) and are measured word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.runtime import discard, materialise
from ..functions.words import word_string

TRAIN, EVAL = 1, 2
RUN = 3
#: Slots by which crowded intervals are known, rows of an interval that are never crowded, and rows of a partition of the array.
SLOTS, CROWDED, PART_ROWS = 1 << 17, 1_000_000, 1_000_000
#: Bytes of text that a task digests at once.
SLICE = 8 << 20
_RATIO = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _byte_values() -> np.ndarray:
    """A 64-bit number for each byte, from the mixing function of a known generator."""
    z = np.arange(1, 257, dtype=np.uint64) * _RATIO
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


_BYTE = _byte_values()


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def run_digests(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, digest) of the distinct runs of RUN words of every text, in order of text, then digest.

    Words are parted by single spaces. A digest is a polynomial in the bytes of the run, taken from sums over the whole
    slice, so that no word is touched on its own.
    """
    data = np.frombuffer("\n".join(texts).encode(), np.uint8)
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gap = np.flatnonzero((data == 32) | (data == 10))
    first, past = np.append(0, gap + 1), np.append(gap, len(data))
    text = np.concatenate(([0], np.cumsum(data[gap] == 10)))
    whole = np.flatnonzero(text[: len(text) - RUN + 1] == text[RUN - 1 :]) if len(text) >= RUN else np.zeros(0, np.int64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_RATIO, len(data)), out=sums[1:])
    lo, hi = first[whole], past[whole + RUN - 1]
    h = (sums[hi] - sums[lo]) * _powers(_BACK, len(data) + 1)[lo]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    at = text[whole]
    order = np.lexsort((h, at))
    at, h = at[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (at[1:] != at[:-1]) | (h[1:] != h[:-1])
    return at[new], h[new]


def slices(texts: list[str], size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Bounds of slices of `texts` of about `size` characters; a longer text is a slice of its own."""
    lo, n = 0, 0
    for k, t in enumerate(texts):
        if n and n + len(t) > size:
            yield lo, k
            lo, n = k, 0
        n += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(head, cls, meta): the suffixes of each text by the digest of their leading run; meta is four times their number, plus the side."""
    for b in batches:
        texts, cls, side = b.column("norm").to_pylist(), b.column("cls").to_numpy(), b.column("side").to_numpy()
        for lo, hi in slices(texts):
            at, h = run_digests(texts[lo:hi])
            n = np.bincount(at, minlength=hi - lo)
            yield pa.record_batch({"head": pa.array(h.view(np.int64)), "cls": pa.array(cls[lo:hi][at]), "meta": pa.array((n * 4 + side[lo:hi])[at])})


SUFFIX = "head long, cls long, meta long"


def _shared(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Of sorted suffixes with all of their neighbours: those in intervals where two texts of different sides meet."""
    head, cls, meta = (np.concatenate(x) for x in zip(*parts))
    first = np.flatnonzero(np.r_[True, head[1:] != head[:-1]]) if len(head) else np.zeros(0, np.int64)
    rows = np.diff(np.append(first, len(head)))
    trains, evals = (np.add.reduceat((meta & s > 0).astype(np.int64), first) if len(first) else first for s in (TRAIN, EVAL))
    both = (trains > 0) & (evals > 0) & (rows > 1)
    keep, size = np.repeat(both, rows), np.repeat(trains + evals, rows)
    return pa.record_batch({"head": head[keep], "cls": cls[keep], "meta": meta[keep], "size": size[keep]})


def _intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partition of the array, sorted by head, as a stream: the shared suffixes and how many meet in their interval.

    An interval that is open at the end of a batch is held until it ends; none has more rows than a crowded slot.
    """
    held: list[tuple[np.ndarray, ...]] = []
    for b in batches:
        if not b.num_rows:
            continue
        cols = tuple(b.column(c).to_numpy() for c in ("head", "cls", "meta"))
        open_at = int(np.searchsorted(cols[0], cols[0][-1]))
        if open_at or held and held[-1][0][-1] != cols[0][0]:
            yield _shared([*held, tuple(c[:open_at] for c in cols)])
            held = []
        held.append(tuple(c[open_at:] for c in cols))
    if held:
        yield _shared(held)


def text_classes(df: DataFrame, id_col: str, split_col: str, text_col: str, least_words: int, train: str, evals: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(classes, members): each distinct sequence of words once, and the rows of each class by its digest."""
    side = F.when(F.col(split_col) == train, TRAIN).when(F.col(split_col).isin(*evals), EVAL)
    rows = df.select(F.col(id_col).alias("rid"), side.alias("side"), word_string(F.col(text_col)).alias("norm")).where(
        "side is not null and rid is not null and norm is not null"
    )
    # Normalised once and written: classes read the texts, members the narrow keys beside them.
    rows = materialise(rows.where(F.size(F.split("norm", " ")) >= least_words).select("rid", "side", "norm", *_key()))
    classes = rows.groupBy("norm").agg(F.min("rid").alias("cls"), F.bit_or("side").alias("side"))
    return classes, rows.select("rid", "side", "k1", "k2", "k3")


def _key() -> list:
    return [F.xxhash64("norm").alias("k1"), F.crc32("norm").alias("k2"), F.length("norm").alias("k3")]


def shared_suffixes(suffixes: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(head, cls, meta, size): of written suffixes those whose leading run stands on both sides, with the texts that meet there.

    Intervals of crowded slots, which hold more than `crowded` rows and more than eight times the mean, are not gathered:
    their suffixes count as shared by as many texts as their slot has rows. There are fewer than SLOTS / 8 such slots, and
    taking a run for shared adds candidates but loses none.
    """
    spark = suffixes.sparkSession
    slot = F.shiftrightunsigned("head", 64 - 17).cast("int")
    counts = suffixes.groupBy(slot.alias("slot")).agg(F.count("*").alias("rows"))
    whole = counts.agg(F.sum("rows")).first()[0] or 0
    most = max(crowded, 8 * whole // SLOTS)
    parts = max(spark.sparkContext.defaultParallelism, -(-whole // PART_ROWS))
    busy = counts.where(F.col("rows") > most)
    crowd = [(r["slot"], r["rows"]) for r in busy.collect()] if whole > most else []
    place = F.floor(F.shiftrightunsigned("head", 33) * F.lit(parts) / F.lit(1 << 31)).cast("int")
    array, apart = suffixes, None
    if crowd:
        named = F.broadcast(spark.createDataFrame(crowd, "slot int, size long"))
        slotted = suffixes.withColumn("slot", slot)
        array, apart = slotted.join(named, "slot", "left_anti").drop("slot"), slotted.join(named, "slot").drop("slot")
    shared = array.repartitionById(parts, place).sortWithinPartitions("head").mapInArrow(_intervals, SUFFIX + ", size long")
    return shared if apart is None else shared.unionByName(apart)


def candidate_pairs(classes: DataFrame, share: tuple[int, int], crowded: int = CROWDED) -> DataFrame:
    """(a, b): classes of the training side and of the evaluation side that meet in one of their least shared suffixes.

    The suffixes that a text has alone come first in its order and use up its prefix, so a text covered by less than
    `share` has none left.
    """
    by = Window.partitionBy("cls").orderBy("size", "head")
    covered = F.count("*").over(by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    suffixes = materialise(classes.select("norm", "cls", "side").mapInArrow(_suffixes, SUFFIX))
    placed = shared_suffixes(suffixes, crowded).withColumns({"covered": covered, "place": F.row_number().over(by)})
    placed = placed.withColumns({"n": F.shiftright("meta", 2), "side": F.col("meta").bitwiseAND(3)})
    needed = F.ceil(F.col("n") * share[0] / share[1])
    # `rest`: how many suffixes of the text stand at or after this one in its order
    chosen = materialise(placed.where(F.col("place") <= F.col("covered") - needed + 1).select("head", "cls", "side", "n", (F.col("covered") - F.col("place") + 1).alias("rest")))
    discard(suffixes)
    a = chosen.where(F.col("side").bitwiseAND(TRAIN) != 0).select("head", F.col("cls").alias("a"), F.col("n").alias("na"), F.col("rest").alias("ra"))
    b = chosen.where(F.col("side").bitwiseAND(EVAL) != 0).select("head", F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("rest").alias("rb"))
    # At their first common suffix, what follows in either must still hold the share: c / (na + nb - c) >= share.
    enough = F.least("ra", "rb") * (share[0] + share[1]) >= (F.col("na") + F.col("nb")) * share[0]
    return a.join(b, "head").where(enough & (F.col("a") != F.col("b"))).select("a", "b").distinct()


def _measure(share: tuple[int, int]):
    """Exact share of common runs of each pair and, where it is reached, the words of either text in shared spans and the longest span."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for a, c, x, y in zip(*(b.column(k).to_pylist() for k in ("a", "b", "ta", "tb"))):
                u, v = x.split(" "), y.split(" ")
                r, s = [list(zip(w, w[1:], w[2:])) for w in (u, v)]
                p, q = set(r), set(s)
                common = p & q
                if len(common) * share[1] < len(p | q) * share[0]:
                    continue
                cover: list[int] = []
                for runs in (r, s):
                    words = longest = now = 0
                    last = -RUN  # the last word covered, and how long its span is
                    for i, run in enumerate(runs):
                        if run in common:
                            add = min(RUN, i + RUN - 1 - last)
                            now = now + add if i <= last + 1 else RUN
                            words, last, longest = words + add, i + RUN - 1, max(longest, now)
                    cover += [words, longest]
                out.append((a, c, len(common), len(p | q), *cover))
            cols = list(zip(*out)) if out else [[]] * 8
            yield pa.record_batch({k: pa.array(c, pa.int64()) for k, c in zip(PAIR, cols)})

    return run


PAIR = ("a", "b", "common", "either", "words_a", "longest_a", "words_b", "longest_b")


def _class_pairs(classes: DataFrame, share: tuple[int, int], crowded: int) -> DataFrame:
    pairs = materialise(candidate_pairs(classes, share, crowded))
    named = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    text = materialise(classes.select("cls", "norm").join(named, "cls", "left_semi"))
    both = pairs.join(text.withColumnsRenamed({"cls": "a", "norm": "ta"}), "a").join(text.withColumnsRenamed({"cls": "b", "norm": "tb"}), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(_measure(share), ", ".join(f"{k} long" for k in PAIR))


def overlapping_classes(
    df: DataFrame, id_col: str = "example_id", split_col: str = "split", text_col: str = "text",
    least_words: int = 24, share: tuple[int, int] = (3, 5), train: str = "train", evals: tuple[str, ...] = ("validation", "test"), crowded: int = CROWDED,
) -> tuple[DataFrame, DataFrame]:
    """(pairs, members). pairs: classes `a` of the training side and `b` of the evaluation side whose texts share at least
    `share` of the distinct runs of three words of either, with common and either, the words of each text in shared
    spans and its longest span. members: (cls, rid, row_side) of all classes that are in a pair.

    A class is one sequence of words, named by its smallest id; a class with rows of both sides is in a pair with itself.
    Rows with null id, split or text, of other splits, or of fewer than `least_words` words are in no class (at least three
    words are needed for a run). An empty table gives empty results; other columns are ignored.
    """
    classes, rows = text_classes(df, id_col, split_col, text_col, max(RUN, least_words), train, evals)
    classes = materialise(classes)
    found = _class_pairs(classes, share, crowded)
    size, one = F.size(F.split("norm", " ")).cast("long"), F.lit(1).cast("long")
    same = classes.where(F.col("side") == (TRAIN | EVAL)).select(*[x.alias(k) for k, x in zip(PAIR, (F.col("cls"), F.col("cls"), one, one, size, size, size, size))])
    pairs = materialise(found.unionByName(same))
    named = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    keys = classes.join(named, "cls", "left_semi").select("cls", *_key())
    # Written once: both sides of the pairs are read from it.
    return pairs, materialise(rows.join(keys, ["k1", "k2", "k3"]).select("cls", "rid", F.col("side").alias("row_side")))


def _sides(members: DataFrame, a: str, b: str) -> tuple[DataFrame, DataFrame]:
    return (
        members.where(F.col("row_side") == TRAIN).select(F.col("cls").alias("a"), F.col("rid").alias(a)),
        members.where(F.col("row_side") == EVAL).select(F.col("cls").alias("b"), F.col("rid").alias(b)),
    )


def row_pairs(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(train_id, eval_id, common, either, train_words, eval_words): the pairs of classes spelled out as pairs of rows."""
    ta, te = _sides(members, "train_id", "eval_id")
    return pairs.join(ta, "a").join(te, "b").select("train_id", "eval_id", "common", "either", F.col("words_a").alias("train_words"), F.col("words_b").alias("eval_words"))


def cross_split_overlaps(df: DataFrame, **options) -> DataFrame:
    """Every pair of rows across the splits: `overlapping_classes`, spelled out by `row_pairs`, since this result names rows."""
    return row_pairs(*overlapping_classes(df, **options))


def overlap_report(pairs: DataFrame, members: DataFrame, rows: DataFrame, id_col: str = "example_id", split_col: str = "split", source_col: str = "project") -> DataFrame:
    """(eval_split, source, pairs, eval_rows, train_rows) per evaluation split and its source, from classes and their sizes.

    Pairs of rows are counted, not made: a training class adds its number of rows once per evaluation row, and once per
    group to the distinct training rows.
    """
    ta, te = _sides(members, "rid", "eval_id")
    trains = ta.groupBy("a").agg(F.count("*").alias("trains"))
    at = rows.select(F.col(id_col).alias("eval_id"), F.col(split_col).alias("eval_split"), F.col(source_col).alias("source"))
    per = te.join(at, "eval_id").groupBy("eval_split", "source", "b").agg(F.count("*").alias("evals"), F.countDistinct("eval_id").alias("ids"))
    per = per.select(F.struct("eval_split", "source").alias("g"), "b", "evals", "ids")  # a struct joins null sources too
    links = pairs.select("a", "b").join(trains, "a").join(per, "b")
    shape = links.groupBy("g", "a").agg(F.sum(F.col("trains") * F.col("evals")).alias("pairs"), F.first("trains").alias("trains"))
    counted = shape.groupBy("g").agg(F.sum("pairs").alias("pairs"), F.sum("trains").alias("train_rows"))
    met = links.select("g", "b", "ids").distinct().groupBy(F.col("g").alias("h")).agg(F.sum("ids").alias("eval_rows"))
    return counted.join(met, F.col("g").eqNullSafe(F.col("h"))).select("g.eval_split", "g.source", "pairs", "eval_rows", "train_rows")
