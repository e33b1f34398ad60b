"""Problem 6: splits that keep related records together.

Records and their entities (cell, polygon, document) form a bipartite graph. Minimum-label propagation with
shortcuts finds its components; whole components are then dealt to the splits so that sizes and label shares
come close to the wanted ones.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.runtime import materialise

#: Hash buckets that small components are dealt in, and the share of all rows from which a component is dealt on its own.
BUCKETS, LARGE = 2048, 1 / 2000


def _entity(df: DataFrame, column: str, kind: int):
    return F.when(F.col(column).isNotNull(), F.concat(F.lit(f"{kind}:"), F.col(column).cast("string")))


def _edges(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """(spoke, hub): every other entity of a record tied to the record's first one; equal records once.

    A record itself is a node of degree one per entity, so tying its entities to the first of them has the same
    components. A hub that is a spoke elsewhere (where the first column is null) is kept as its own spoke.
    """
    names = [_entity(df, c, k) for k, c in enumerate(columns)]
    rows = df.select(F.coalesce(*names).alias("hub"), *[n.alias(f"e{k}") for k, n in enumerate(names)])
    spokes = F.array_compact(F.array(*[F.when((F.col(f"e{k}") != F.col("hub")) | F.lit(k > 0), F.col(f"e{k}")) for k in range(len(columns))]))
    return rows.select("hub", F.explode(spokes).alias("spoke")).distinct()


def components(df: DataFrame, columns: tuple[str, ...] = ("h3_cell", "polygon_id", "document_id"), rounds: int = 60) -> DataFrame:
    """(hub, label): the smallest hub of the component of each hub that is tied to another hub.

    Hubs are the entities of the first column, written `0:value` (where it is null, of the next one). Entities
    with one hub tie nothing and take no part, so the iterated graph holds only real ties. Labels only fall;
    each round also follows the label's own label, so rounds grow with the logarithm of the diameter.
    """
    edges = _edges(df, columns)
    ties = edges.groupBy("spoke").agg(F.min("hub").alias("low"), F.max("hub").alias("high")).where("low < high").select("spoke")
    graph = materialise(edges.join(ties, "spoke", "left_semi"))
    labels = materialise(graph.groupBy("hub").agg(F.min("hub").alias("label")))
    for _ in range(rounds):
        low = graph.join(labels, "hub").groupBy("spoke").agg(F.min("label").alias("low"))
        # a new label for the hub, and for the hub that its old label names
        seen = graph.join(low, "spoke").groupBy("hub").agg(F.min("low").alias("low")).join(labels, "hub")
        offers = seen.select("hub", "low").unionByName(seen.select(F.col("label").alias("hub"), "low")).groupBy("hub").agg(F.min("low").alias("low"))
        fallen = labels.join(offers, "hub").select("hub", F.least("label", "low").alias("next"), "label")
        short = fallen.select(F.col("hub").alias("next"), F.col("next").alias("further"))
        step = materialise(fallen.join(short, "next").select("hub", F.least("next", "further").alias("next"), "label"))
        labels = step.select("hub", F.col("next").alias("label"))
        if step.where("next < label").isEmpty():
            return labels
    raise RuntimeError(f"labels still change after {rounds} rounds")


def tied_cells(df: DataFrame, cell_col: str = "h3_cell", polygon_col: str = "polygon_id", document_col: str = "document_id") -> DataFrame:
    """(cell_a, cell_b): the smallest cell of each group of tied cells, and each other cell of it.

    Null cells, polygons or documents tie nothing by themselves, but a row of null cell still ties its polygon to its
    document. A cell tied to no other cell is in no row; an empty table gives an empty result.
    """
    labels = components(df, (cell_col, polygon_col, document_col)).where(F.col("hub").startswith("0:"))
    # The smallest label of a group is a cell: "0:" sorts before "1:" and "2:".
    return labels.where("hub > label AND label LIKE '0:%'").select(F.substring("label", 3, 1 << 30).alias("cell_a"), F.substring("hub", 3, 1 << 30).alias("cell_b"))


def _deal(sizes: np.ndarray, order: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """The split of each unit: greedy, largest first, each where the squared deviation of label counts grows least."""
    total = sizes.sum(0)
    want = shares[:, None] * total[None, :]
    scale = 1 / np.maximum(total, 1)
    have = np.zeros_like(want)
    out = np.zeros(len(sizes), int)
    for i in order:
        dev = have - want
        cost = ((2 * dev * sizes[i] + sizes[i] ** 2) * scale**2).sum(1) + ((2 * dev.sum(1) * sizes[i].sum() + sizes[i].sum() ** 2) / total.sum() ** 2)
        cost = cost / shares  # a small split is filled as carefully as a large one
        out[i] = int(np.argmin(cost))
        have[out[i]] += sizes[i]
    return out


def grouped_splits(
    df: DataFrame, id_col: str = "example_id", label_col: str = "worldcover_code",
    columns: tuple[str, ...] = ("h3_cell", "polygon_id", "document_id"),
    shares: tuple[tuple[str, float], ...] = (("train", 0.8), ("validation", 0.1), ("test", 0.1)), labels_most: int = 256,
) -> DataFrame:
    """(id, component, new_split): every row with its component and split; a component never spans splits.

    Components of more than LARGE of all rows (so fewer than 1/LARGE) are dealt one by one; all others fall into hash
    buckets of the components with the same main label, BUCKETS in all but at least 8 a label, and whole buckets are dealt.
    What the driver sees is a count per unit and label, bounded by BUCKETS and `labels_most`, whatever the number of rows;
    labels beyond the `labels_most` most frequent ones are balanced as one, which drops no row.
    A row without any entity is a component of its own. An empty table gives an empty result.
    """
    names = [_entity(df, c, k) for k, c in enumerate(columns)]
    labels = components(df, columns)
    rows = df.select(F.col(id_col).alias("rid"), F.coalesce(*names, F.concat(F.lit("9:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("hub"), F.col(label_col).cast("string").alias("y"))
    rows = materialise(rows.join(labels, "hub", "left").select("rid", F.coalesce("label", "hub").alias("component"), F.coalesce("y", F.lit("")).alias("y")))
    kinds = [r["y"] for r in rows.groupBy("y").count().orderBy(F.desc("count"), "y").limit(labels_most).collect()]
    at = rows.withColumn("y", F.when(F.col("y").isin(kinds), F.col("y")).otherwise("other")) if kinds else rows
    counted = at.groupBy("component", "y").agg(F.count("*").alias("n"))
    whole = rows.count()
    groups = counted.groupBy("component").agg(F.sum("n").alias("n"), F.max_by("y", F.struct("n", "y")).alias("most"))
    each = max(8, BUCKETS // (len(kinds) + 1))
    bucket = F.concat(F.lit("b"), "most", F.lit("-"), F.pmod(F.xxhash64("component"), F.lit(each)))
    units = materialise(groups.select("component", F.when(F.col("n") > whole * LARGE, F.concat(F.lit("c"), "component")).otherwise(bucket).alias("unit")))
    sums = counted.join(units, "component").groupBy("unit", "y").agg(F.sum("n").alias("n")).collect()
    names_u = sorted({r["unit"] for r in sums})
    names_y = sorted({r["y"] for r in sums})
    sizes = np.zeros((len(names_u), max(1, len(names_y))))
    iu, iy = {u: i for i, u in enumerate(names_u)}, {y: i for i, y in enumerate(names_y)}
    for r in sums:
        sizes[iu[r["unit"]], iy[r["y"]]] = r["n"]
    split = _deal(sizes, np.lexsort((np.arange(len(names_u)), -sizes.sum(1))), np.array([s for _, s in shares]))
    spark = df.sparkSession
    plan = spark.createDataFrame([(u, shares[k][0]) for u, k in zip(names_u, split)], "unit string, new_split string")
    placed = units.join(F.broadcast(plan), "unit").select("component", "new_split")
    return rows.select("rid", "component").join(placed, "component").select(F.col("rid").alias(id_col), "component", "new_split")
