"""Words and canonical forms: the longest runs of letters and digits of any script, lower-cased."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NOT_ALNUM = r"[^\p{L}\p{N}]+"


def word_string(text: Column) -> Column:
    """The words of a text joined by single spaces; null for null, '' where there is no word."""
    return F.trim(F.regexp_replace(F.lower(text), NOT_ALNUM, " "))


def bare(text: Column) -> Column:
    """Letters and digits only, lower-cased and in order."""
    return F.regexp_replace(F.lower(text), NOT_ALNUM, "")
