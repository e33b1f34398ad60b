"""Text normalisation, keys and counts as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Unicode counts as white space; no predefined class of the pattern language has all of it.
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def normalise(text: Column) -> Column:
    """White space of any kind becomes one space, none at the ends. Null stays null."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def word_count(text: Column) -> Column:
    """Words between white space; 0 for empty and null texts."""
    norm = normalise(text)
    return F.when(F.coalesce(norm, F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(norm, " "))).cast("long")


def is_usable(text: Column, least: int) -> Column:
    return word_count(text) >= least


def dedup_key(text: Column, label: Column) -> Column:
    """Hex digest of the normalised text, a zero byte and the label; null text or label counts as empty."""
    part = lambda c: F.encode(F.coalesce(c, F.lit("")), "UTF-8")
    return F.sha2(F.concat(part(normalise(text)), F.unhex(F.lit("00")), part(label.cast("string"))), 256)


def text_hash(text: Column) -> Column:
    """32-byte digest of the normalised text."""
    return F.unhex(F.sha2(normalise(text), 256))


def usable_text(text: Column) -> Column:
    """Trimmed of any white space; null where nothing is left."""
    bare = F.regexp_replace(text, f"^{SPACE}|{SPACE}$", "")
    return F.when(bare != "", bare)
