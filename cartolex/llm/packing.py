"""Problem 8: documents in containers of fixed token capacity, whole unless longer than a container.

Packing works on counts of lengths, so it does not grow with the number of documents: single, pair and triple sums that
fill a container exactly are looked up among the lengths that are left and consumed as often as their counts allow;
what remains is packed best fit, with gaps closed by the same sums. A container pattern is used many times; documents
find theirs by the rank they have among documents of their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.runtime import materialise, spread
from .budget import FILE, TOKENIZERS, tokenizer

#: Documents that one hash range is made for; documents are ranked and numbered within ranges.
RANGE_ROWS = 500_000


def _count_tokens(folder: str, file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(folder, file)
        for b in batches:
            sizes = [len(t) for t in encoder.encode_ordinary_batch(b.column("text").to_pylist(), num_threads=1)]
            yield pa.record_batch({"id": b.column("id"), "tokens": pa.array(sizes, pa.int64())})

    return run


def token_lengths(df: DataFrame, id_col: str, text_col: str, folder: str = TOKENIZERS, file: str = FILE) -> DataFrame:
    """(id, tokens) by a public tokenizer; null texts have no tokens."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return spread(rows).mapInArrow(_count_tokens(folder, file), f"id {kind}, tokens long")


def _complement(have: np.ndarray, gap: int) -> tuple[int, ...]:
    """One, two or three available lengths that sum to `gap` exactly, or nothing. `have` holds counts by length."""
    if gap < 1:
        return ()
    if have[gap]:
        return (gap,)
    half = np.arange(1, gap // 2 + 1)
    both = half[(have[half] > 0) & (have[gap - half] > 0)]
    for a in both[::-1]:
        if a * 2 != gap or have[a] > 1:
            return (int(gap - a), int(a))
    lengths = np.flatnonzero(have[:gap])
    for a in lengths[::-1]:  # the longest of the three; the others are no longer than it
        rest = gap - int(a)
        if rest > 2 * a:
            break
        half = np.arange(max(1, rest - int(a)), rest // 2 + 1)
        ok = half[(have[half] > 0) & (have[rest - half] > 0)]
        for b in ok[::-1]:
            trio = (int(a), rest - int(b), int(b))
            if all(have[x] >= trio.count(x) for x in trio):
                return trio
    return ()


def pack(counts: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """(times, lengths) patterns that use every item once: `counts` says how many items each length up to `capacity` has.

    Every step uses up a length or a pattern's supply, so there are at most a few patterns per length.
    """
    have = np.zeros(capacity + 1, np.int64)
    for k, n in counts.items():
        have[k] = n
    have[0] = 0
    out: list[tuple[int, tuple[int, ...]]] = []

    def use(pattern: tuple[int, ...]) -> None:
        kinds, need = np.unique(pattern, return_counts=True)
        times = int((have[kinds] // need).min())
        have[kinds] -= times * need
        out.append((times, pattern))

    if have[capacity]:
        use((capacity,))
    for a in range(capacity - 1, (capacity + 1) // 2 - 1, -1):  # exact pairs
        b = capacity - a
        if b and have[a] and have[b] and (a != b or have[a] > 1):
            use((a, b))
    for a in range(capacity - 2, 0, -1):  # exact triples, longest first
        while have[a]:
            rest = capacity - a
            half = np.arange(max(1, rest - a), rest // 2 + 1)
            ok = half[(have[half] > 0) & (have[rest - half] > 0)]
            trio = next(((a, rest - int(b), int(b)) for b in ok[::-1] if all(have[x] >= (a, rest - int(b), int(b)).count(x) for x in (a, rest - int(b), int(b)))), ())
            if not trio:
                break
            use(trio)
    while have.any():  # the longest item left, then best fits; the last gap by an exact sum where there is one
        pattern = [int(np.flatnonzero(have)[-1])]
        have[pattern[0]] -= 1
        gap = capacity - pattern[0]
        taken = [pattern[0]]
        while gap > 0:
            close = _complement(have, gap)
            if close:
                add = list(close)
            else:
                fits = np.flatnonzero(have[: gap + 1])
                if not len(fits):
                    break
                add = [int(fits[-1])]
            for x in add:
                have[x] -= 1
                taken.append(x)
                gap -= x
        for x in taken:
            have[x] += 1
        use(tuple(taken))
    return out


def containers(
    df: DataFrame, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", lengths: DataFrame | None = None,
    folder: str = TOKENIZERS, file: str = FILE,
) -> DataFrame:
    """(id, part, tokens, container): every document in one container, or in parts where it is longer than one.

    A longer document has full containers of its own and its rest is packed as an item (its last part). A document
    without tokens (null or empty text) needs no room: part 0, 0 tokens, container null. Repeated rows are items of
    their own; an empty table gives an empty result. What the driver sees is a count per length, at most `capacity`
    numbers; the plan it returns has a few rows per pattern and is joined by length and rank.
    """
    sized = (lengths or token_lengths(df, id_col, text_col, folder, file)).select(F.col("id"), "tokens")
    full = F.floor(F.col("tokens") / capacity)
    whole = F.when((F.col("tokens") % capacity == 0) & (full > 0), full - 1).otherwise(full)
    # ranks among equal lengths, by hash ranges, so that no task orders a hot length alone
    items = sized.select("id", "tokens", whole.alias("fulls"), (F.col("tokens") - whole * capacity).alias("size"))
    items = materialise(items)
    ranges = max(64, -(-items.count() // RANGE_ROWS))
    items = items.withColumn("r", F.pmod(F.xxhash64("id"), F.lit(ranges)))
    per = items.where("size > 0").groupBy("size", "r").agg(F.count("*").alias("n"))
    before = Window.partitionBy("size").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    starts = per.select("size", "r", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    counts = {r["size"]: r["n"] for r in per.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    plan, used, base = [], dict.fromkeys(counts, 0), 0
    for times, pattern in pack(counts, capacity):
        for size in sorted(set(pattern)):
            k = pattern.count(size)
            plan.append((size, used[size], used[size] + k * times, k, base))
            used[size] += k * times
        base += times
    spark = df.sparkSession
    rows = spark.createDataFrame(plan, "size long, first long, past long, per long, base long")
    # Runs of a length are numbered by steps of ranks: a length has few patterns, each pattern one run.
    # The starts grow with the ranges, so the planner decides how they are joined; a shuffle by (size, r) is there anyway.
    local = items.where("size > 0").withColumn("local", F.row_number().over(Window.partitionBy("size", "r").orderBy("id")))
    ranked = local.join(starts, ["size", "r"]).withColumn("rank", F.col("start") + F.col("local") - 1)
    runs = rows.groupBy("size").agg(F.array_sort(F.collect_list(F.struct("first", "past", "per", "base"))).alias("runs"))
    placed = ranked.join(F.broadcast(runs), "size")
    run = F.element_at(F.filter("runs", lambda x: (x["first"] <= F.col("rank")) & (F.col("rank") < x["past"])), 1)
    placed = placed.withColumn("run", run).select(
        "id", F.col("fulls").alias("part"), F.col("size").alias("tokens"), (F.col("run.base") + F.floor((F.col("rank") - F.col("run.first")) / F.col("run.per"))).alias("container")
    )
    # Full containers of long documents: named by their document's place in the packed order of long ones.
    long = items.where("fulls > 0").groupBy("r").agg(F.sum("fulls").alias("n"))
    at = long.select("r", (F.coalesce(F.sum("n").over(Window.orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + base).alias("at"))
    own = items.where("fulls > 0").join(at, "r").withColumn(
        "own", F.col("at") + F.coalesce(F.sum("fulls").over(Window.partitionBy("r").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    own = own.select("id", F.explode(F.sequence(F.lit(0), F.col("fulls") - 1)).alias("part"), F.lit(capacity).cast("long").alias("tokens"), "own").withColumn("container", F.col("own") + F.col("part")).drop("own")
    none = items.where("size <= 0").select("id", F.lit(0).cast("long").alias("part"), F.lit(0).cast("long").alias("tokens"), F.lit(None).cast("long").alias("container"))
    names = [F.col("id").alias(id_col), F.col("part").cast("long").alias("part"), "tokens", F.col("container").cast("long").alias("container")]
    return placed.select(names).unionByName(own.select(names)).unionByName(none.select(names))


def fill(placed: DataFrame, capacity: int = 2048) -> DataFrame:
    """(containers, least, tokens, unused_share, fullest): how well containers are filled. `least` is the fewest that any packing needs by size alone."""
    by = placed.where("container is not null").groupBy("container").agg(F.sum("tokens").alias("tokens"))
    unused = F.when(F.count("*") > 0, F.round(1 - F.sum("tokens") / (F.count("*") * capacity), 6))
    return by.agg(F.count("*").alias("containers"), F.ceil(F.coalesce(F.sum("tokens"), F.lit(0)) / capacity).alias("least"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), unused.alias("unused_share"), F.max("tokens").alias("fullest"))
