"""Problem 1: records that differ only in white space, case, punctuation or field order.

Dictionary encoding: every distinct raw value of a column is canonicalised once, every distinct
canonical field value gets an integer, and a record becomes (class code, polygon integer, sorted
integers of its text's fields). Equal records are equal tuples, so the grouping moves integers only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.runtime import materialise
from ..functions.words import bare

BLANK = r"[\s\p{Z}\x{200B}-\x{200D}\x{2060}\x{FEFF}]"
PART = r"[;|\r\n\x{0085}\x{2028}\x{2029}]|//"
FIELD = rf"^{BLANK}*([^:=]*?[\p{{L}}\p{{N}}][^:=]*?)(?::|=|{BLANK}+-{BLANK}+)(.*)$"
#: Values that one range of identifiers is made for.
RANGE_ROWS = 500_000


def text_fields(text: Column) -> Column:
    """Canonical values of a text: its sorted distinct `label=value` fields, or the text as one value.

    A text is made of fields where it has two parts or more and each part has a label and a value.
    """
    parts = F.filter(F.split(text, PART), lambda s: s.rlike(r"[\p{L}\p{N}]"))
    label = lambda s: bare(F.regexp_extract(s, FIELD, 1))
    value = lambda s: bare(F.regexp_extract(s, FIELD, 2))
    fields = F.array_sort(F.array_distinct(F.transform(parts, lambda s: F.concat(label(s), F.lit("="), value(s)))))
    made = (F.size(parts) >= 2) & F.forall(parts, lambda s: s.rlike(FIELD) & (label(s) != "") & (value(s) != ""))
    return F.when(F.coalesce(made, F.lit(False)), fields).otherwise(F.array(bare(text)))


def dictionary(values: DataFrame, column: str, rows: int) -> DataFrame:
    """(value, id): a distinct integer for each distinct value of `column`, of which there are at most `rows`.

    The integer is the rank inside one of as many hash ranges as `rows` asks for, times that number, plus the range: no
    single task orders all values, and a task that is run again gives the same integers.
    """
    ranges = 1 + rows // RANGE_ROWS
    distinct = values.select(F.col(column).alias("value")).distinct()
    ranged = distinct.withColumn("r", F.pmod(F.xxhash64("value"), F.lit(ranges)))
    rank = F.row_number().over(Window.partitionBy("r").orderBy("value"))
    return ranged.select("value", (rank.cast("long") * ranges + F.col("r")).alias("id"))


def encoded(df: DataFrame, id_col: str, code_col: str, polygon_col: str, text_col: str) -> DataFrame:
    """(rid, code, pid, tup): each record as integers. Nulls stay apart: a null equals a null only."""
    rows = df.select(
        F.col(id_col).alias("rid"), F.col(code_col).alias("code"), F.col(polygon_col).alias("polygon"), F.col(text_col).alias("text"),
        F.unhex(F.md5(F.col(text_col))).alias("tkey"),
    )
    # Each distinct raw text once; from here on texts are known by their digest. What is left of them is narrow and written
    # once, as both the dictionary and the tuples are made of it.
    texts = rows.where("text is not null").groupBy("text").agg(F.first("tkey").alias("tkey"))
    digests = materialise(texts.select("tkey", F.transform(text_fields(F.col("text")), lambda v: F.unhex(F.md5(v))).alias("fields")))
    pieces = digests.select("tkey", F.explode("fields").alias("piece"))
    known = digests.agg(F.coalesce(F.sum(F.size("fields")), F.lit(0))).first()[0]
    tuples = (
        pieces.join(dictionary(pieces, "piece", known), F.col("piece") == F.col("value"))
        .groupBy("tkey").agg(F.array_sort(F.collect_list("id")).alias("tup"))  # as long as one text has fields
    )
    polygons = materialise(rows.select("polygon").where("polygon is not null").distinct().withColumn("canon", bare(F.col("polygon"))))
    pids = polygons.join(dictionary(polygons, "canon", polygons.count()), F.col("canon") == F.col("value")).select("polygon", F.col("id").alias("pid"))
    return (
        rows.select("rid", "code", "polygon", "tkey")
        .join(tuples, "tkey", "left").join(pids, "polygon", "left")
        .select("rid", "code", "pid", "tup")
    )


def collapse(
    df: DataFrame, id_col: str = "example_id", code_col: str = "worldcover_code",
    polygon_col: str = "polygon_id", text_col: str = "text",
) -> DataFrame:
    """One row per distinct record: keep_id (smallest id), code, copies (rows that equal it, itself included).

    Null code, polygon or text equals only null there; an empty text equals any text without letters and
    digits; an empty table gives an empty result; rows of null id count as copies but are never kept unless alone.
    Other columns are ignored. Partial aggregation runs before the shuffle, so a hot record costs one row a task.
    """
    rows = encoded(df, id_col, code_col, polygon_col, text_col)
    return rows.groupBy("code", "pid", "tup").agg(F.min("rid").alias("keep_id"), F.count("*").alias("copies")).select(
        "keep_id", F.col("code").alias(code_col), "copies"
    )


def copies(
    df: DataFrame, id_col: str = "example_id", code_col: str = "worldcover_code",
    polygon_col: str = "polygon_id", text_col: str = "text",
) -> DataFrame:
    """(keep_id, copy_id): one row per record that equals an earlier one. See `collapse` for the cases.

    Groups are found by partial aggregation and joined back to the narrow rows, which are written once for both; only groups
    of several rows take part, and adaptive execution splits the rows of a hot group over tasks.
    """
    rows = encoded(df, id_col, code_col, polygon_col, text_col)
    key = F.md5(F.to_json(F.struct(F.col("code").cast("string").alias("c"), "pid", "tup")))
    keyed = materialise(rows.select("rid", F.unhex(key).alias("k")))
    kept = keyed.groupBy("k").agg(F.min("rid").alias("keep_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    return keyed.join(kept, "k").where("rid > keep_id").select("keep_id", F.col("rid").alias("copy_id"))
