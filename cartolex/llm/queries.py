"""Queries of the package over the given tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.runtime import read_table
from . import budget, dressed, layout, leakage, linked, overlap, packing, residue, stuffing, tongues


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return dressed.copies(read_table(spark, sf, "release_rows"))


def p1_collapsed(spark: SparkSession, sf: str) -> DataFrame:
    return dressed.collapse(read_table(spark, sf, "release_rows"))


def p2_slices(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "release_rows")
    return budget.slices(budget.row_tokens(rows, budget.fitted(rows)))


def p2_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "release_rows")
    return budget.row_tokens(rows, budget.fitted(rows))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    pairs = overlap.cross_split_overlaps(read_table(spark, sf, "release_rows"))
    return pairs.selectExpr("least(train_id, eval_id) AS id_a", "greatest(train_id, eval_id) AS id_b")


def p3_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "release_rows")
    return overlap.overlap_report(*overlap.overlapping_classes(rows), rows)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return residue.residue_pages(read_table(spark, sf, "website"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    rows, pages = read_table(spark, sf, "release_rows"), read_table(spark, sf, "website")
    model = tongues.fitted(rows)
    found = tongues.mislabelled(rows, model, "release_rows")
    return found.unionByName(tongues.mislabelled_pages(pages, model, residue.fitted(pages), "website"))


def p5_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Every text of the release and of the website, and every segment of it; a text's own row has no segment_no."""
    rows, pages = read_table(spark, sf, "release_rows"), read_table(spark, sf, "website")
    model = tongues.fitted(rows)
    found = tongues.segment_languages(rows, model, whole=True).withColumn("tab_name", F.lit("release_rows"))
    of_pages = tongues.segment_languages(pages, model, "page_id", "website_text", whole=True, pages=layout.fitted(pages)).withColumn("tab_name", F.lit("website"))
    return found.unionByName(of_pages).select("tab_name", F.col("id").alias("row_id"), "segment_no", "segment", "lang", "confidence")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return linked.tied_cells(read_table(spark, sf, "release_rows"))


def p6_splits(spark: SparkSession, sf: str) -> DataFrame:
    return linked.grouped_splits(read_table(spark, sf, "release_rows"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    pages = read_table(spark, sf, "website")
    judge = residue.fitted(pages)
    return layout.furniture_lines(pages, judge.lines, skip=judge)


def p7_bodies(spark: SparkSession, sf: str) -> DataFrame:
    pages = read_table(spark, sf, "website")
    return layout.bodies(pages, layout.fitted(pages))


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    return packing.containers(read_table(spark, sf, "documents"))


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    """One row: containers used, the fewest possible by size, and the share of space that is left over."""
    return packing.fill(packing.containers(read_table(spark, sf, "documents")))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaked(read_table(spark, sf, "documents"), read_table(spark, sf, "eval_items")).select("doc_id", "item_id")


def p9_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Passages as long as twenty words in any item, with one edit per that length."""
    return leakage.leaked(read_table(spark, sf, "documents"), read_table(spark, sf, "eval_items"), words=20, edits=1, exact=False)


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return stuffing.stuffed_documents(read_table(spark, sf, "documents")).select("doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p1_collapsed, p2_slices, p2_rows, p3_found, p3_report, p4_found, p5_found, p5_segments, p6_found, p6_splits, p7_found, p7_bodies, p8_containers, p8_fill, p9_found, p9_passages, p10_found)
}

# SQL for the problems whose results are exactly defined. The others are tested by brute force, round trips or held-out rows.

BARE = "regexp_replace(lower({0}), '[^\\p{L}\\p{N}]+', '', 'g')"
BLANK = "[\\s\\p{Z}\\x{200B}-\\x{200D}\\x{2060}\\x{FEFF}]"
FIELD = f"^{BLANK}*([^:=]*?[\\p{{L}}\\p{{N}}][^:=]*?)(:|=|{BLANK}+-{BLANK}+)(.*)$"
PART = "[;|\\r\\n\\x{85}\\x{2028}\\x{2029}]|//"
LABEL, VALUE = (BARE.replace("{0}", f"regexp_extract(x, '{FIELD}', {k})") for k in (1, 3))
TUPLES = f"""cut AS (SELECT example_id, worldcover_code, {BARE.replace('{0}', 'polygon_id')} AS p, text, list_filter(regexp_split_to_array(text, '{PART}'), lambda x: regexp_matches(x, '[\\p{{L}}\\p{{N}}]')) AS parts FROM release_rows),
  made AS (SELECT *, len(parts) >= 2 AND len(list_filter(parts, lambda x: regexp_matches(x, '{FIELD}') AND {LABEL} <> '' AND {VALUE} <> '')) = len(parts) AS is_made FROM cut),
  tup AS (SELECT example_id, worldcover_code, p, CASE WHEN is_made THEN list_sort(list_distinct(list_transform(parts, lambda x: {LABEL} || '=' || {VALUE}))) ELSE [{BARE.replace('{0}', 'text')}] END AS k FROM made),
  kept AS (SELECT example_id, worldcover_code, min(example_id) OVER (PARTITION BY worldcover_code, p, k) AS keep_id FROM tup)"""
WORD_LIST = "regexp_extract_all(lower({0}), '[\\p{L}\\p{N}]+')"


def _runs(n: int) -> str:
    return f"list_distinct(list_transform(range(1, len(w) - {n - 2}), lambda i: array_to_string(w[i : i + {n - 1}], ' ')))"


SQL: dict[str, str] = {
    "p1_found": f"WITH {TUPLES} SELECT keep_id, example_id AS copy_id FROM kept WHERE example_id > keep_id",
    "p1_collapsed": f"WITH {TUPLES} SELECT keep_id, worldcover_code, count(*) AS copies FROM kept GROUP BY 1, 2",
    "p3_found": f"""WITH t AS (SELECT example_id, split = 'train' AS tr, {WORD_LIST.replace('{0}', 'text')} AS w FROM release_rows WHERE split IN ('train', 'validation', 'test')),
      r AS (SELECT example_id, tr, {_runs(3)} AS s FROM t WHERE len(w) >= 24), u AS (SELECT example_id, tr, len(s) AS n, unnest(s) AS g FROM r),
      c AS (SELECT a.example_id AS x, b.example_id AS y, a.n AS nx, b.n AS ny, count(*) AS k FROM u a JOIN u b ON a.g = b.g WHERE a.tr AND NOT b.tr GROUP BY 1, 2, 3, 4)
      SELECT least(x, y) AS id_a, greatest(x, y) AS id_b FROM c WHERE 5 * k >= 3 * (nx + ny - k)""",
    "p6_found": """WITH RECURSIVE e AS (SELECT DISTINCT a.h3_cell AS x, b.h3_cell AS y FROM release_rows a JOIN release_rows b ON a.polygon_id = b.polygon_id AND a.h3_cell <> b.h3_cell
      UNION SELECT DISTINCT a.h3_cell, b.h3_cell FROM release_rows a JOIN release_rows b ON a.document_id = b.document_id AND a.h3_cell <> b.h3_cell),
      reach AS (SELECT x, y FROM e UNION SELECT reach.x, e.y FROM reach JOIN e ON reach.y = e.x)
      SELECT low AS cell_a, x AS cell_b FROM (SELECT x, least(x, min(y)) AS low FROM reach GROUP BY x) WHERE low < x""",
    "p9_found": f"""WITH i AS (SELECT item_id, {WORD_LIST.replace('{0}', 'text')} AS w FROM eval_items), d AS (SELECT doc_id, {WORD_LIST.replace('{0}', 'text')} AS w FROM documents),
      a AS (SELECT item_id, unnest({_runs(12)}) AS g FROM i WHERE len(w) >= 12), b AS (SELECT doc_id, unnest({_runs(12)}) AS g FROM d WHERE len(w) >= 12)
      SELECT DISTINCT doc_id, item_id FROM a JOIN b ON a.g = b.g""",
}
