"""Problem 10: keyword-stuffed pages and lists of links, places or product tags.

Terms of a spam page come back at short or at regular gaps. For every word the operator looks at the gaps to its next and
previous use, at the autocorrelation of positions over a window of lags, and over the whole document at gaps of any
length that keep equal; stretches where most words recur that way, and lists of many names without function words, are spam, sentences about a place are not. A document is a case
where most of its words stand in such stretches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.runtime import spread
from .overlap import slices

# Function words of the languages of the texts.
FUNCTION = frozenset(
    " ".join((
        "the of and to in a is was from at on with are it by as has that be which who",
        "der die das und ist von den dem ein eine im zu mit auf wird in bei man sich nur",
        "le la les des du et un une est à au en par dans qui pour on sur ont mais",
        "el los las y del una por se con que son muy hay para fue aunque cada",
        "il lo gli di che è nel dal della al si sono per ma ogni dopo",
        "o os da do em um uma é foi no na há não ao",
        "het een van op te zijn niet naar je voor ook wie heeft die",
        "och att det är på som av för till med man den inte ett",
        "w z na się i jest do od że nie po są tu aby który która",
        "и в на с не из от до что который через можно за у к это",
    )).split()
)
#: Words by which a recurring term must come back, and the lags over which positions are correlated.
GAP, LAGS = 7, 8
#: Uses of a term in one period of a regular repetition, and sentences that the period may go through.
EVEN_USES, EVEN_UNITS = 3, 2
#: Shares of recurring words from which a stretch is stuffed, and of function words under which a list has none.
STUFFED, BARE = 0.5, 0.06
#: Words of a stretch from which one without function words is a list, and share of words with digits of price lists.
LONG, PRICED = 16, 0.25
#: Share of its sentences' words from which a key phrase is stuffed.
KEYED = 0.34
#: Share of words in such stretches from which a document is a case: a clear majority, as addresses count several words each
#: and articles may end in long lists.
MOST_SHARE = 0.6
#: Characters of text that are judged at once.
AT_ONCE = 1_000_000
UNIT = re.compile(r"(?<=[.!?…。])\s+|\n+")
TOKEN = re.compile(r"[^\W_]+")
HOST = re.compile(r"https?://|www\.|\b[a-z0-9-]+\.(?:example|com|org|net|info|de|fr|es|it|nl|eu)\b", re.I)
ITEMS = re.compile(r"\s*[;|/•»>*#]\s*|,\s+|\s[-–]\s")
FIELD = re.compile(r"^\s*[^\W\d_][^:=]{0,24}\s*(?::|=|\s-\s)\s*\S")
KANA = re.compile(r"[\u3041-\u309f]")  # particles and endings: a word with one is no bare name
LIST_MARK = re.compile(r"^\s*[*>»•#–-]")


def _runs(codes: np.ndarray, gap: int, least: int) -> np.ndarray:
    """Of each position: whether its code is used `least` times or more in a row with gaps of at most `gap`."""
    n = len(codes)
    out = np.zeros(n, bool)
    if n < least:
        return out
    order = np.argsort(codes, kind="stable")
    c, at = codes[order], order
    new = np.ones(n, bool)
    new[1:] = (c[1:] != c[:-1]) | (at[1:] - at[:-1] > gap)
    run = np.cumsum(new) - 1
    out[at] = np.bincount(run)[run] >= least
    return out


def _pairs(codes: np.ndarray, plain: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A number for each pair of neighbouring words; pairs of function words, or across documents, are all different."""
    n = len(codes)
    _, pair = np.unique(codes[:-1] * (n + 1) + codes[1:], return_inverse=True)
    return np.where((plain[:-1] | plain[1:]) & (doc[:-1] == doc[1:]), pair, -1 - np.arange(n - 1))


def recurrence(codes: np.ndarray, plain: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Of each word: whether it is part of a term that keeps coming back at short gaps. Words of different documents have different codes.

    A pair of neighbouring words, not both function words, counts from three uses with gaps of at most GAP; a single
    word that is no function word from four uses with gaps of at most GAP - 1.
    """
    n = len(codes)
    out = _runs(np.where(plain, codes, -1 - np.arange(n)), GAP - 1, 4)
    if n > 2:
        at = np.flatnonzero(_runs(_pairs(codes, plain, doc), GAP, 3))
        out[at] = True
        out[at + 1] = True
    return out


def _even(codes: np.ndarray, unit: np.ndarray) -> np.ndarray:
    """Of each position: whether its code comes back three times or more at even gaps, however long these are.

    A code may be used up to EVEN_USES times in a period; gaps are even that differ by one word or a tenth at most. A gap
    leads into one of the next EVEN_UNITS sentences: what comes back after more of them is a passage said again.
    """
    n = len(codes)
    out = np.zeros(n, bool)
    at = np.argsort(codes, kind="stable")
    c = codes[at]
    for k in range(1, EVEN_USES + 1):
        if n <= 3 * k:
            break
        d = at[k:] - at[:-k]
        trio = np.stack((d[: n - 3 * k], d[k : n - 2 * k], d[2 * k :]))
        most = trio.max(0)
        near = unit[at[k:]] - unit[at[:-k]] <= EVEN_UNITS
        near = near[: n - 3 * k] & near[k : n - 2 * k] & near[2 * k :]
        even = np.flatnonzero(near & (c[3 * k :] == c[: n - 3 * k]) & (most - trio.min(0) <= np.maximum(1, most // 10)))
        for j in range(4):
            out[at[even + j * k]] = True
    return out


def regularity(codes: np.ndarray, plain: np.ndarray, unit: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Of each word: whether it is part of a term that keeps coming back at even gaps over the whole document.

    Terms are those of `recurrence`: words that are no function words, and pairs of words that are not both.
    """
    n = len(codes)
    out = _even(np.where(plain, codes, -1 - np.arange(n)), unit)
    if n > 2:
        at = np.flatnonzero(_even(_pairs(codes, plain, doc), unit))
        out[at] = out[at + 1] = True
    return out


def _key_phrase(codes: np.ndarray, plain: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Of each word: whether it stands in the pair of words that in its document most often comes back at short gaps."""
    out = np.zeros(len(codes), bool)
    if len(codes) < 6:
        return out
    pair = _pairs(codes, plain, doc)
    runs = np.flatnonzero(_runs(pair, GAP, 3))
    if len(runs):
        kinds, first, n = np.unique(pair[runs], return_index=True, return_counts=True)
        of = doc[runs[first]]
        order = np.lexsort((kinds, -n, of))  # of a document's pairs the most frequent one, the first seen at ties
        best = kinds[order[np.r_[True, of[order][1:] != of[order][:-1]]]]
        at = np.flatnonzero(np.isin(pair, best))
        out[at] = out[at + 1] = True
    return out


def autocorrelation(codes: np.ndarray, unit: np.ndarray | None = None, last: int = LAGS) -> tuple[np.ndarray, np.ndarray]:
    """(lag, share) of each unit: the lag at which most words equal the word that many places on in the unit, and the share that do."""
    unit = np.zeros(len(codes), np.int64) if unit is None else unit
    n = np.bincount(unit)
    at, best = np.zeros(len(n), np.int64), np.zeros(len(n))
    for lag in range(1, min(last, len(codes) - 1) + 1):
        same = (codes[lag:] == codes[:-lag]) & (unit[lag:] == unit[:-lag])
        share = np.bincount(unit[:-lag], weights=same, minlength=len(n)) / np.maximum(1, n)
        at, best = np.where(share > best, lag, at), np.maximum(best, share)
    return at, best


def _cut(text: str) -> tuple[list[str], list[list[str]]]:
    """(units, words of each) of a text: sentences and lines, with lines of a list taken together."""
    units: list[str] = []
    words: list[list[str]] = []
    listed = False
    for u in UNIT.split(text):
        w = TOKEN.findall(u)
        if not w:
            continue
        named = ("." in u[:-1] or "://" in u) and HOST.search(u)
        item = bool(named or LIST_MARK.match(u)) or len(w) <= 8 and u.rstrip()[-1] not in ".!?…。" and not u.startswith("==")
        if units and listed and item:
            units[-1] += "\n" + u
            words[-1] += w
        else:
            units.append(u)
            words.append(w)
            listed = item
    return units, words


class _Seen:
    """What is asked of a word alone, remembered: 1 a function word, 2 only digits, 4 a digit in it, 8 no bare name. The memory is bounded."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def of(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > 500_000:
            known.clear()
        out = []
        for w in words:
            x = known.get(w)
            if x is None:
                f = w in FUNCTION
                x = known[w] = f + 2 * w.isdigit() + 4 * any(c.isdigit() for c in w) + 8 * (f or bool(KANA.search(w)))
            out.append(x)
        return np.array(out, np.int64)


def judged(texts: list[str], seen: _Seen | None = None, lags_only: bool = False) -> list[list[tuple[str, int, bool]]]:
    """(stretch, words, spam) of each text; gaps, lags and counts are worked out for all texts at once.

    `lags_only` goes by gaps and lags alone, without the rules for lists.
    """
    seen = seen or _Seen()
    cut = [_cut(t) for t in texts]
    flat = [w.lower() for _, words in cut for ws in words for w in ws]
    out: list[list[tuple[str, int, bool]]] = [[] for _ in texts]
    if not flat:
        return out
    size = np.array([len(ws) for _, words in cut for ws in words])
    unit = np.repeat(np.arange(len(size)), size)
    doc_of = np.repeat(np.arange(len(cut)), [len(u) for u, _ in cut])
    doc = doc_of[unit]
    known: dict[tuple[int, str], int] = {}
    codes = np.array([known.setdefault(k, len(known)) for k in zip(doc.tolist(), flat)])
    facts = seen.of(flat)
    plain = facts & 3 == 0
    first = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    per = lambda x: np.add.reduceat(x.astype(float), first) / size
    again = recurrence(codes, plain, doc)
    share, beats = per(again), per(again | regularity(codes, plain, unit, doc))
    key = np.add.reduceat(_key_phrase(codes, plain, doc).astype(np.int64), first)
    bare, digits, pl, beat = per(facts & 8 > 0), per(facts & 4 > 0), per(plain), autocorrelation(codes, unit)[1]
    stuffed = (size >= 6) & ((share >= STUFFED) | (size >= 12) & (beat >= 0.4) & (pl > 0.5))
    few = bare <= 2 * BARE
    k = 0
    for d, (units, _) in enumerate(cut):
        for u in units:
            n, bad = int(size[k]), bool(stuffed[k])
            even = n >= 6 and beats[k] >= STUFFED
            if not bad and lags_only:
                bad = even
            elif not bad and (few[k] or even):
                parts = [x for x in ITEMS.split(u.replace("\n", ";")) if x.strip()]
                items = len(parts)
                if not (items >= 2 and sum(bool(FIELD.match(x)) for x in parts) * 2 >= items):  # labelled fields are no list
                    names = n >= 8 and items >= 4 and bare[k] <= (BARE if items < 8 else 2 * BARE) and n / items <= 6 or n >= LONG and bare[k] <= BARE
                    bad = bool(even or names or few[k] and (n >= 12 and digits[k] >= PRICED or n >= 2 * LONG and share[k] >= KEYED / 2))
                bad = bad or bool(few[k] and (u.count("#") >= 3 or len(HOST.findall(u)) >= 2))
            out[d].append((u, n, bad))
            k += 1
    # Sentences that only repeat one key phrase: together they are stuffed although single ones may not be.
    said, of = np.bincount(doc_of, weights=key, minlength=len(cut)), np.bincount(doc_of, weights=np.where(key > 0, size, 0), minlength=len(cut))
    start = np.concatenate(([0], np.cumsum([len(u) for u, _ in cut])))
    for d in np.flatnonzero((of > 0) & (said >= KEYED * of)):
        out[d] = [(u, n, bad or key[start[d] + i] > 0) for i, (u, n, bad) in enumerate(out[d])]
    return out


def stretches(text: str) -> list[tuple[str, int, bool]]:
    """(stretch, words, spam) of one text."""
    return judged([text])[0]


def spam_share(text: str) -> tuple[int, int]:
    """(words in spam stretches, words)."""
    s = stretches(text)
    return sum(n for _, n, bad in s if bad), sum(n for _, n, _ in s)


def _find(share: float, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = _Seen()
        for b in batches:
            texts = b.column("text").to_pylist()
            parts = [x for lo, hi in slices(texts, AT_ONCE) for x in judged(texts[lo:hi], seen)]
            counts = [(sum(n for _, n, bad in s if bad), sum(n for _, n, _ in s)) for s in parts]
            case = [n >= least and bad > share * n for bad, n in counts]
            yield pa.record_batch({
                "id": b.column("id").filter(pa.array(case, pa.bool_())),
                "spam_words": pa.array([x for (x, _), c in zip(counts, case) if c], pa.int64()),
                "words": pa.array([n for (_, n), c in zip(counts, case) if c], pa.int64()),
            })

    return run


def stuffed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = MOST_SHARE, least: int = 8) -> DataFrame:
    """(id, spam_words, words): documents more than `share` of whose words stand in keyword or link spam.

    Null ids or texts, texts of fewer than `least` words, and an empty table give no row; repeated rows come out
    repeated. Whole texts are read; nothing is shuffled.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    return spread(rows).mapInArrow(_find(share, least), "id long, spam_words long, words long").withColumnRenamed("id", id_col)
