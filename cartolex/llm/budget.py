"""Problem 2: estimated tokens per text, and in total per source, language and domain.

Per language a ridge regression predicts the tokens of an existing tokenizer from bytes, words, digits, punctuation and
counts of scripts. It is fitted on a bounded sample that is tokenized, its bias is corrected by the ratio of true to
predicted totals of a holdout, and it is applied to all rows as plain column arithmetic.
"""

from __future__ import annotations

import base64
import os
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tongues import label_language

TOKENIZERS = "/opt/tokenizers"
FILE = "byte_bpe_multi_50k.tiktoken"
# Fixed value: how such vocabularies split a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FEATURES = ("bytes", "chars", "words", "digits", "punctuation", "latin", "cyrillic", "kana_han")
#: Rows of each language that are tokenized: of every three, two are fitted and one is held out.
SAMPLE = 450
#: Languages with a model of their own; all others share one.
MOST_LANGUAGES = 60


def tokenizer(folder: str = TOKENIZERS, file: str = FILE):
    """The encoder of a public vocabulary of byte ranks."""
    import tiktoken

    with open(os.path.join(folder, file), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def features(text: Column) -> dict[str, Column]:
    """Counts of a text; all zero for an empty one."""
    count = lambda pattern: F.length(text) - F.length(F.regexp_replace(text, pattern, ""))
    return {
        "bytes": F.octet_length(text), "chars": F.length(text), "words": F.size(F.split(F.trim(text), r"\s+")), "digits": count(r"\p{Nd}"),
        "punctuation": count(r"[\p{P}\p{S}]"), "latin": count(r"\p{IsLatin}"), "cyrillic": count(r"\p{IsCyrillic}"), "kana_han": count(r"[\p{IsHiragana}\p{IsKatakana}\p{IsHan}]"),
    }


def slice_language(label: Column) -> Column:
    """The two-letter code of the language a label names, else the label's first part in lower case; '' for none."""
    return F.coalesce(label_language(label), F.lower(F.element_at(F.split(F.trim(label), "[-_]"), 1)), F.lit(""))


def domain(url: Column) -> Column:
    """Host of a url in lower case, without scheme, user, port and leading `www.`; '' where there is none."""
    rest = F.regexp_replace(F.lower(F.trim(url)), r"^(?:[a-z][a-z0-9+.-]*:)?//", "")
    host = F.regexp_extract(rest, r"^(?:[^/@?#]*@)?([^/:?#\s]+)", 1)
    return F.coalesce(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def _ridge(x: np.ndarray, y: np.ndarray, strength: float = 1e-3) -> np.ndarray:
    scale = np.maximum(1e-9, x.std(0))
    a = np.hstack((np.ones((len(x), 1)), x / scale))
    eye = np.eye(a.shape[1]) * strength * len(x)
    eye[0, 0] = 1e-9
    w = np.linalg.solve(a.T @ a + eye, a.T @ y)
    w[1:] /= scale
    return w


class Budget:
    """Coefficients and correction by language; '*' for languages without enough texts."""

    def __init__(self, rows: list[tuple[str, str, list[int]]], encoder, least: int = 30) -> None:
        tokens = [len(t) for t in encoder.encode_ordinary_batch([t for _, t, _ in rows], num_threads=2)] if rows else []
        x = np.array([f for _, _, f in rows], float).reshape(len(rows), len(FEATURES))
        y, lang = np.array(tokens, float), np.array([k for k, _, _ in rows], object)
        held = np.arange(len(rows)) % 3 == 2
        self.models: dict[str, tuple[np.ndarray, float]] = {}
        self.error: dict[str, tuple[float, float]] = {}
        for name in ["*", *sorted(set(lang))]:
            at = np.ones(len(rows), bool) if name == "*" else lang == name
            if name != "*" and at.sum() < least or not at.any():
                continue
            w = _ridge(x[at & ~held], y[at & ~held])
            p = np.maximum(0, w[0] + x[at & held] @ w[1:])
            true = y[at & held]
            ratio = float(true.sum() / p.sum()) if len(true) and p.sum() else 1.0
            self.models[name] = (w, ratio)
            if len(true):
                self.error[name] = (float(abs(ratio - 1)), float(np.mean(abs(p * ratio - true) / np.maximum(1, true))))
        self.models.setdefault("*", (np.zeros(len(FEATURES) + 1), 1.0))

    def estimate(self, text: Column, lang: Column) -> Column:
        """Tokens of a text as a column; 0 for null and empty texts."""
        f = features(text)
        # one array of coefficients per row, so that every count is computed once
        known = {k: F.lit([float(c * r) for c in w]) for k, (w, r) in self.models.items()}
        coef = known.pop("*")
        if known:
            coef = F.coalesce(F.try_element_at(F.create_map(*[x for k, c in known.items() for x in (F.lit(k), c)]), lang), coef)
        value = reduce(lambda a, b: a + b, [f[k] * F.get(coef, i + 1) for i, k in enumerate(FEATURES)], F.get(coef, 0))
        return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), value))


def fitted(df: DataFrame, text_col: str = "text", lang_col: str = "language", folder: str = TOKENIZERS, file: str = FILE, sample: int = SAMPLE) -> Budget:
    """Fit on at most `sample` rows of each of the MOST_LANGUAGES most frequent languages, those of smallest hash."""
    rows = df.select(F.col(text_col).alias("t"), slice_language(F.col(lang_col)).alias("l")).where("t is not null and t != ''")
    often = [r["l"] for r in rows.groupBy("l").count().orderBy(F.desc("count"), "l").limit(MOST_LANGUAGES).collect()]
    if not often:
        return Budget([], tokenizer(folder, file))
    order = Window.partitionBy("l").orderBy(F.xxhash64("t"), "t")
    picked = rows.where(F.col("l").isin(often)).withColumn("k", F.row_number().over(order)).where(F.col("k") <= sample)
    f = features(F.col("t"))
    got = picked.select("l", "t", "k", F.array(*[f[k].cast("long") for k in FEATURES]).alias("f")).collect()
    return Budget([(r["l"], r["t"], r["f"]) for r in sorted(got, key=lambda r: (r["l"], r["k"]))], tokenizer(folder, file))


def row_tokens(df: DataFrame, budget: Budget, id_col: str = "example_id", text_col: str = "text", lang_col: str = "language", project_col: str = "project", url_col: str = "url") -> DataFrame:
    """(id, project, lang, domain, tokens) of every row, null ids included; null and empty texts have 0 tokens.

    `lang` is the code of the labelled language, else the label's first part in lower case; missing languages, projects and domains are ''.
    """
    lang = slice_language(F.col(lang_col))
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), lang.alias("lang"), F.coalesce(F.col(project_col), F.lit("")).alias("project"), domain(F.col(url_col)).alias("domain"))
    return rows.select(F.col("id").alias(id_col), "project", "lang", "domain", budget.estimate(F.col("text"), F.col("lang")).alias("tokens"))


def slices(rows: DataFrame) -> DataFrame:
    """(project, lang, domain, texts, tokens): totals per slice; partial sums are made before the shuffle."""
    return rows.groupBy("project", "lang", "domain").agg(F.count("*").alias("texts"), F.sum("tokens").alias("tokens"))
