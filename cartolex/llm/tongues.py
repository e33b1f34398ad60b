"""Problem 5: the languages that texts are written in, whatever their labels say.

An interpolated Kneser-Ney model of the characters of words for each language; the n-grams of all languages stand in
one sorted array of hashes with a row of probabilities each. A word is scored once per task for all languages, a
segment by the sum over its words; the language of lowest cross-entropy per character wins, unless its calibrated
limit is passed: a segment that costs as much as a language's unseen words do is `und`, written in none of the languages.
Models count all labelled texts. Limits and confidence are calibrated on all of them as well, each text read by models
that counted the other half of the texts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.runtime import spread
from . import residue
from .layout import Lines

LANGUAGES = ("en", "de", "fr", "es", "it", "pt", "nl", "sv", "pl", "ru", "ja")
# Codes and names of these languages.
SPELLINGS = {
    "en": "eng english", "de": "deu ger german deutsch", "fr": "fra fre french français", "es": "spa spanish español", "it": "ita italian italiano",
    "pt": "por portuguese português", "nl": "nld dut dutch nederlands", "sv": "swe swedish svenska", "pl": "pol polish polski", "ru": "rus russian русский", "ja": "jpn japanese 日本語",
}
NAMED = {x: k for k, v in SPELLINGS.items() for x in (k, *v.split())}
#: The outcome for what is written in none of the languages.
UNKNOWN = "und"
ORDER = 5
#: Letters and spaces from which a segment alone can be told to be in none of the languages.
TOLD = 24
#: Deviations beyond a limit from which a few letters do.
FAR = 8.0
#: Lead, as the logarithm of a ratio of probabilities, from which a segment is clearly in a language.
CLEAR = 9.0
#: Costs per character and logarithms of leads are tallied by so many steps a unit.
COST_STEPS, LEAD_STEPS = 4096, 256
#: Distinct words that a task counts before it spells them and passes the n-grams on.
AT_ONCE = 300_000
WORDS = re.compile(r"[^\W\d_]+")
#: Ends of segments: ends of sentences, fields and lines. All begin with one class of characters, so that the search skips others.
SEGMENTS = re.compile(r"[\s。！？;|/](?:(?<=[.!?…]\s)\s*|(?<=[。！？;|\n\r])[。！？;|\n\r]*|(?<=\s)[–/]\s|(?<=/)/)")
_MUL = 0x9E3779B97F4A7C15


def label_language(label: Column) -> Column:
    """The language a label names: a known code or name, with region or script after `-` or `_`; null if none of them."""
    first = F.lower(F.element_at(F.split(F.trim(label), "[-_]"), 1))
    named = F.create_map(*[F.lit(x) for kv in NAMED.items() for x in kv])
    return F.when(first != "", F.try_element_at(named, first))


def _side(text: str) -> int:
    """Which half of the texts, or of the words, one belongs to: 0 or 1."""
    return zlib.crc32(text.encode()) & 1


@lru_cache(1 << 18)
def _side_of_word(word: str) -> int:
    return _side(word)


def _hashes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n-grams of one length, a row of characters each, and of what stands before their last character."""
    h = before = np.full(len(codes), codes.shape[1], np.uint64)
    for c in codes.T:
        before = h
        h = (h ^ c) * np.uint64(_MUL)
        h ^= h >> np.uint64(29)
    return h, before


class Grams:
    """Counts of the n-grams of all languages: a row each of its language, characters, length and counts."""

    def __init__(self, table: pa.Table, names: list[str]) -> None:
        self.lang = pc.index_in(table["l"], pa.array(names, pa.string())).to_numpy().astype(np.int64)
        self.size = pc.utf8_length(table["g"]).to_numpy().astype(np.int64)
        self.codes = np.zeros((len(table), ORDER), np.uint64)
        row = np.repeat(np.arange(len(table)), self.size)
        place = np.arange(len(row)) - np.repeat(np.cumsum(self.size) - self.size, self.size)
        self.codes[row, place] = np.frombuffer("".join(table["g"].to_pylist()).encode("utf-32-le"), np.uint32)
        #: of texts of either side, and of words of side 1
        self.sides = [table[c].to_numpy().astype(np.int64) for c in ("n0", "n1")]
        self.half = table["half"].to_numpy().astype(np.int64)


class Tongues:
    """The models of all languages, of texts by language; `fitted` makes those of a table."""

    def __init__(self, samples: dict[str, list[str]]) -> None:
        rows = [(k, t) for k in LANGUAGES for t in samples.get(k, ())]
        table = pa.table({"l": pa.array([k for k, _ in rows], pa.string()), "t": pa.array([t for _, t in rows], pa.string())})

        def gathered(*passes: Pass) -> pa.Table:
            found = table
            for run, schema, keys in passes:
                found = pa.Table.from_batches(run(iter(found.to_batches(max_chunksize=10_000))), _arrow(schema))
                sums = [c for c in found.column_names if c not in keys]
                found = found.group_by(keys).aggregate([(c, "sum") for c in sums]).rename_columns({f"{c}_sum": c for c in sums})
            return found

        self._fit(gathered)

    def _fit(self, gathered: Callable[..., pa.Table]) -> None:
        """`gathered` runs a pass over all labelled texts, and others over what comes out, each summed by its keys.

        Counts of the texts of the other side tell which texts and segments are in another language than their label's, so
        that no text vouches for itself; those of the rest make the models. A language none of whose texts is read as its own keeps them all.
        """
        raw = gathered(_counting(None), SPELLING)
        there = pc.unique(raw["l"]).to_pylist()
        self.names = [k for k in LANGUAGES if k in there]
        self.limit, self.apart, self.slope = np.full(len(self.names), np.inf), np.ones(len(self.names)), (1.0, 0.0)
        grams = Grams(raw, self.names)
        if not self.names:
            self._count(grams, grams.half)
            return
        own = gathered(_counting((self._like(grams, grams.sides[1]), self._like(grams, grams.sides[0]))), SPELLING)
        lost = raw.filter(pc.invert(pc.is_in(raw["l"], own["l"].combine_chunks())))
        grams = Grams(pa.concat_tables([own, lost]), self.names)
        self._count(grams, sum(grams.sides))
        others = [self._like(grams, counts) for counts in (grams.sides[1], grams.sides[0], grams.half)]
        self._calibrate(gathered(_costing(*others)))

    def _like(self, grams: Grams, counts: np.ndarray) -> Tongues:
        """Models of the same languages by other counts."""
        other = Tongues.__new__(Tongues)
        other.names = self.names
        other._count(grams, counts)
        return other

    def _count(self, grams: Grams, counts: np.ndarray) -> None:
        self.cache: dict[str, int] = {}
        self.kept: list[np.ndarray] = []
        self.long: list[np.ndarray] = []
        alpha: list[tuple[np.ndarray, int, np.ndarray]] = []
        gamma: list[tuple[np.ndarray, int, np.ndarray]] = []
        for j in range(len(self.names)):
            at = np.flatnonzero((grams.lang == j) & (counts > 0))
            # shorter ones are starts of words and keep their counts
            starts = {k: at[grams.size[at] == k] for k in range(1, ORDER)}
            top = at[grams.size[at] == ORDER]
            g, n = grams.codes[top], counts[top]
            # counts of the highest order as they are, of lower orders by the characters that come before
            for k in range(ORDER, 0, -1):
                if k < ORDER:
                    _, first, n = np.unique(_hashes(g[:, 1:])[0], return_index=True, return_counts=True)
                    g, n = np.concatenate((g[first, 1:], grams.codes[starts[k], :k])), np.concatenate((n, counts[starts[k]]))
                told = n if k < ORDER else counts[at]
                once, twice = int((told == 1).sum()), int((told == 2).sum())
                d = once / (once + 2 * twice) if once else 0.5
                h, before = _hashes(g)
                context, of = np.unique(before, return_inverse=True)
                total, kinds = np.bincount(of, n), np.bincount(of)
                alpha.append((h, j, np.maximum(n - d, 0) / total[of]))
                gamma.append((context, j, d * kinds / total))
        self.alpha_key, self.alpha = self._table(alpha, 0)
        self.gamma_key, self.gamma = self._table(gamma, 1)

    def _table(self, parts: list[tuple[np.ndarray, int, np.ndarray]], absent: float) -> tuple[np.ndarray, np.ndarray]:
        key, row = np.unique(np.concatenate([np.zeros(0, np.uint64), *(h for h, _, _ in parts)]), return_inverse=True)
        # a last row stands for what is not in the table
        value = np.full((len(key) + 1, len(self.names)), absent, np.float32)
        at = 0
        for h, j, x in parts:
            value[row[at : at + len(h)], j] = x
            at += len(h)
        return key, value

    def _lookup(self, key: np.ndarray, table: np.ndarray, q: np.ndarray) -> np.ndarray:
        if not len(key):
            return table[np.zeros(len(q), np.int64)]
        at = np.minimum(np.searchsorted(key, q), len(key) - 1)
        return table[np.where(key[at] == q, at, len(key))]

    def _words(self, words: list[str]) -> np.ndarray:
        """Log probability of each word under each language."""
        size = np.array([len(w) + 2 for w in words])
        code = np.frombuffer(" ".join(["", *[w + " " for w in words]]).encode("utf-32-le"), np.uint32).astype(np.uint64)
        # the string is " w1  w2  ..." so that every word has its own two spaces
        start = np.concatenate(([0], np.cumsum(size)[:-1]))
        place = np.arange(len(code)) - np.repeat(start, size)
        at = np.flatnonzero(place >= 1)
        p = np.full((len(at), len(self.names)), 1e-5, np.float32)  # a character that no model knows
        for k in range(1, ORDER + 1):
            on = np.flatnonzero(place[at] >= k - 1)
            h = before = np.full(len(on), k, np.uint64)
            for i in range(k):
                before = h
                h = (h ^ code[at[on] - (k - 1) + i]) * np.uint64(_MUL)
                h ^= h >> np.uint64(29)
            p[on] = self._lookup(self.alpha_key, self.alpha, h) + self._lookup(self.gamma_key, self.gamma, before) * p[on]
        word = np.repeat(np.arange(len(words)), size - 1)
        out = np.zeros((len(words), len(self.names)))
        logs = np.log(np.maximum(p, 1e-9))
        return np.add.reduceat(logs, np.flatnonzero(np.r_[True, word[1:] != word[:-1]]), axis=0) if len(word) else out

    def scores(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log probability per language, characters, words) of each segment."""
        split = [WORDS.findall(s.lower()) for s in segments]
        return self._scores(list(chain.from_iterable(split)), np.fromiter(map(len, split), np.int64, len(split)))

    def _scores(self, flat: list[str], count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As `scores`, of segments whose words stand in one list, so many of each."""
        if len(self.cache) > 200_000:
            self.cache.clear()
            self.kept, self.long = [], []
        new = [w for w in dict.fromkeys(flat) if w not in self.cache]
        if new:
            base = sum(len(x) for x in self.kept)
            self.cache.update((w, base + i) for i, w in enumerate(new))
            self.kept.append(self._words(new))
            self.long.append(np.fromiter(map(len, new), np.int64, len(new)))
        if len(self.kept) > 1:
            self.kept, self.long = [np.vstack(self.kept)], [np.concatenate(self.long)]
        out, chars = np.zeros((len(count), len(self.names))), np.zeros(len(count), np.int64)
        if flat:
            ids = np.fromiter(map(self.cache.__getitem__, flat), np.int64, len(flat))
            there = np.flatnonzero(count)
            heads = np.cumsum(count[there]) - count[there]
            out[there] = np.add.reduceat(self.kept[0][ids], heads, axis=0)
            chars[there] = np.add.reduceat(self.long[0][ids], heads) + count[there]
        return out, chars, count

    def own(self, part: Labelled) -> np.ndarray:
        """Which segments are not clearly in another language than their text's label; none of a text that is as a whole."""
        score, _, _ = self._scores(part.flat, part.count)
        return part.fits(score) & (score.max(1) - score[np.arange(len(score)), part.label] < CLEAR)

    def _calibrate(self, costs: pa.Table) -> None:
        """Limits of rejection, and the confidence of a lead.

        The limit of a language is what its own unseen words cost: models of one half of the words (by hash) give the mean
        cross-entropy per character of the other half in running text (but never less than nearly all segments cost that
        its model has not counted). A text of new subjects still has the words that all
        texts of its language share and stays below; a text of another language has none of them. Confidence is the
        logistic regression, on segments of texts not counted, of the best language being the labelled one on the logarithm
        of its lead; texts with a clear segment in another language than their label's are left out, and two counts of
        either outcome are added, so no lead is certain.
        """
        by: dict[tuple[str, str], list[tuple[int, int]]] = {}
        for r in costs.sort_by("at").to_pylist():
            by.setdefault((r["l"], r["kind"]), []).append((r["at"], r["n"]))
        tally = {k: tuple(np.array(v, np.int64).T) for k, v in by.items()}
        for j, name in enumerate(self.names):
            if (name, "rest") not in tally or (name, "rest") in tally and tally[name, "rest"][1].sum() < 20:
                continue
            at, n = tally[name, "rest"]
            at = at / COST_STEPS
            mean = float((at * n).sum() / n.sum())
            self.limit[j], self.apart[j] = mean, max(0.2, float(np.sqrt(((at - mean) ** 2 * n).sum() / n.sum())))
            at, n = tally.get((name, "seen"), (np.zeros(0), np.zeros(0, np.int64)))
            if n.sum() >= 20:
                place, upto = (n.sum() - 1) * 0.999, np.cumsum(n)
                low, high = (at[np.searchsorted(upto, i, "right")] / COST_STEPS for i in (int(place), min(int(place) + 1, int(n.sum()) - 1)))
                self.limit[j] = max(self.limit[j], float(low + (place % 1) * (high - low)))
        found = [(at / LEAD_STEPS, n, kind == "right") for (_, kind), (at, n) in tally.items() if kind in ("right", "wrong")]
        if sum(n.sum() for _, n, _ in found) < 20:
            return
        x = np.concatenate([np.log(np.array([1.0, 1.0, 50.0, 50.0]) + 1e-3), *(at for at, _, _ in found)])
        m = np.concatenate([np.ones(4), *(n for _, n, _ in found)])
        y = np.concatenate([[1.0, 0.0, 1.0, 0.0], *(np.full(len(n), float(right)) for _, n, right in found)])
        w = np.zeros(2)
        for _ in range(30):  # Newton steps of a regression of two numbers
            p = 1 / (1 + np.exp(-(w[0] * x + w[1])))
            g = np.array([(m * (p - y) * x).sum() + 1e-3 * w[0], (m * (p - y)).sum()])
            v = m * p * (1 - p)
            w -= np.linalg.solve(np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-6]]), g)
        self.slope = (float(w[0]), float(w[1]))

    def _lead(self, score: np.ndarray) -> np.ndarray:
        """By how much the best language beats the next, as the logarithm of a ratio of probabilities."""
        if score.shape[1] < 2:
            return np.full(len(score), 50.0)
        two = np.partition(score, -2, axis=1)[:, -2:]
        return two[:, 1] - two[:, 0]

    def _sure(self, gap: np.ndarray) -> np.ndarray:
        """Probability that the language with this lead is right; under a half where another one is more probable."""
        w, b = self.slope
        return np.where(gap > 0, 1 / (1 + np.exp(-(w * np.log(np.maximum(gap, 0) + 1e-3) + b))), 0.5 / (1 + np.maximum(-gap, 0)))

    def _beyond(self, score: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """By how many deviations each segment's best language is beyond its limit."""
        best = score.argmax(1) if score.size else np.zeros(len(score), np.int64)
        return (-score[np.arange(len(score)), best] / np.maximum(1, chars) - self.limit[best]) / self.apart[best]

    def language(self, text: str) -> str | None:
        s, n, _ = self.scores([text])
        return self.names[int(s[0].argmax())] if n[0] and self.names else None

    def read(self, texts: list[list[str]], least: int = 4, margin: float = CLEAR) -> list[list[tuple[int, str, float]]]:
        """For each text (a list of segments): (segment, language, confidence) of every segment that has letters.

        A segment of TOLD letters or more (or of a few that are FAR off) whose best language is beyond the calibrated limit is
        UNKNOWN: it is written in none of the languages; its confidence is how far it is beyond. A segment is clear where its language beats every other by
        `margin` (the logarithm of how much more probable it is), with `least` words or a dozen letters, and is not unknown.
        Other segments take the most probable of the languages of clear ones; a text without any takes the language of
        the whole, and is unknown where all its segments of that length are.
        """
        out: list[list[tuple[int, str, float]]] = [[] for _ in texts]
        flat = [s for t in texts for s in t]
        if not flat or not self.names:
            return out
        score, chars, words = self.scores(flat)
        lead, beyond, best, L = self._lead(score), self._beyond(score, chars), score.argmax(1), len(self.names)
        size = np.array([len(t) for t in texts])
        text = np.repeat(np.arange(len(texts)), size)
        told = (chars >= TOLD) & (words > 1) | (chars >= 6) & (beyond > FAR)
        none = told & (beyond > 0)
        clear = (lead >= margin) & ((words >= least) | (chars >= 12)) & ~none
        # doubtful segments take one of the languages that clear ones have, or that of the whole text
        there = np.zeros((len(texts), L), bool)
        there[text[clear], best[clear]] = True
        whole = np.zeros((len(texts), L))
        whole[size > 0] = np.add.reduceat(score, (np.cumsum(size) - size)[size > 0], axis=0)
        unclear = np.flatnonzero(~there.any(1))
        there[unclear, whole[unclear].argmax(1)] = True
        lost = np.zeros(len(texts), bool)
        lost[text[none]] = True
        lost[text[told & ~none]] = False  # the short ones beside unknown ones tell nothing
        at = np.flatnonzero(chars)
        sc, each = score[at], np.arange(len(at))
        j = np.where(there[text[at]], sc, -np.inf).argmax(1)
        mine = sc[each, j]
        sc[each, j] = -np.inf
        unknown = none[at] | lost[text[at]]
        sure = np.where(unknown, 1 - 0.5 * np.exp(-np.maximum(beyond[at], 0)), self._sure(mine - sc.max(1) if L > 1 else np.full(len(at), 50.0)))
        place = at - (np.cumsum(size) - size)[text[at]]
        names = np.where(unknown, L, j).tolist()
        named = [*self.names, UNKNOWN]
        for t, k, x, c in zip(text[at].tolist(), place.tolist(), names, sure.tolist()):
            out[t].append((k, named[x], c))
        return out


def segments(text: str) -> list[str]:
    return [s for s in SEGMENTS.split(text) if s and s.strip()]


#: What a pass does with batches, the columns it gives, and those by which the others are summed.
Pass = tuple[Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], str, list[str]]


def _arrow(schema: str) -> pa.Schema:
    return pa.schema([(name, pa.string() if kind == "string" else pa.int64()) for name, kind in (c.split() for c in schema.split(", "))])


def _batch(columns: list, schema: str) -> pa.RecordBatch:
    fields = _arrow(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, fields)], fields)


class Labelled:
    """The words of labelled texts that have any: `flat`, of all segments; `count`, so many of each; `label` and `text`, the place of its label and text."""

    def __init__(self, labels: list[str], texts: list[str], names: tuple[str, ...] | list[str] = LANGUAGES, whole: bool = False) -> None:
        split = [[w for s in ([t.lower()] if whole else segments(t.lower())) if (w := WORDS.findall(s))] if k in names else [] for k, t in zip(labels, texts)]
        at = [i for i, x in enumerate(split) if x]
        self.names = names
        size = np.array([len(split[i]) for i in at], np.int64)
        self.parts = list(chain.from_iterable(split))
        self.flat = list(chain.from_iterable(self.parts))
        self.count = np.fromiter(map(len, self.parts), np.int64, len(self.parts))
        self.heads = np.cumsum(size) - size
        self.own = np.array([names.index(labels[i]) for i in at], np.int64)
        self.label, self.text = np.repeat(self.own, size), np.repeat(np.arange(len(size)), size)

    def fits(self, score: np.ndarray) -> np.ndarray:
        """Whether the best language of each segment's whole text is its label's."""
        return (np.add.reduceat(score, self.heads, axis=0).argmax(1) == self.own)[self.text] if len(score) else np.zeros(0, bool)


def _counting(models: tuple[Tongues, Tongues] | None) -> Pass:
    """Counts the words of labelled texts, by their side; with `models`, one for either side, of what they read as the label's language in them."""
    schema = "l string, w string, n0 long, n1 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, tuple[Counter[str], Counter[str]]] = {}

        def counted() -> pa.RecordBatch:
            rows = [(k, w, two[0][w], two[1][w]) for k, two in words.items() for w in two[0].keys() | two[1].keys()]
            return _batch(list(zip(*rows)) or [[]] * 4, schema)

        for b in batches:
            labels, texts = b.column("l").to_pylist(), b.column("t").to_pylist()
            for side in (0, 1):
                at = [i for i, t in enumerate(texts) if _side(t) == side]
                part = Labelled([labels[i] for i in at], [texts[i] for i in at], models[side].names if models else LANGUAGES, whole=not models)
                own = models[side].own(part) if models else np.ones(len(part.label), bool)
                found: dict[str, list[str]] = {}
                for j, ok, ws in zip(part.label.tolist(), own.tolist(), part.parts):
                    if ok:
                        found.setdefault(part.names[j], []).extend(ws)
                for k, ws in found.items():
                    words.setdefault(k, (Counter(), Counter()))[side].update(ws)
            if sum(len(c) for two in words.values() for c in two) > AT_ONCE:
                yield counted()
                words.clear()
        yield counted()

    return run, schema, ["l", "w"]


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-grams of counted words: how often they stand in texts of either side, and in words of side 1."""
    for b in batches:
        out: dict[tuple[str, str], list[int]] = {}
        for lang, w, n0, n1 in zip(*(b.column(c).to_pylist() for c in ("l", "w", "n0", "n1"))):
            mine, p = _side(w) * (n0 + n1), " " + w + " "
            for i in range(1, len(p)):
                c = out.setdefault((lang, p[max(0, i - ORDER + 1) : i + 1]), [0, 0, 0])
                c[0] += n0
                c[1] += n1
                c[2] += mine
        yield _batch([[k[0] for k in out], [k[1] for k in out], *(zip(*out.values()) if out else [[]] * 3)], SPELLING[1])


SPELLING: Pass = (_spell, "l string, g string, n0 long, n1 long, half long", ["l", "g"])


def _costing(even: Tongues, odd: Tongues, half: Tongues) -> Pass:
    """Tallies what segments cost and lead by under models that have not counted them: texts of side 0 are read by `even`, of side 1 by `odd`.

    Kinds: `rest`, cost per character of words of side 0 under `half`, which counted the others; `seen`, cost of segments
    in their label's language; `right` and `wrong`, leads of segments whose best language is the label's, or is not.
    """
    schema = "l string, kind string, at long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally: Counter[tuple[str, str, int]] = Counter()
        for b in batches:
            labels, texts = b.column("l").to_pylist(), b.column("t").to_pylist()
            for side, model in enumerate((even, odd)):
                at = [i for i, t in enumerate(texts) if _side(t) == side]
                part = Labelled([labels[i] for i in at], [texts[i] for i in at], model.names)
                if not part.flat:
                    continue
                label, each = part.label, np.arange(len(part.label))
                score, chars, words = model._scores(part.flat, part.count)
                best, lead, fits = score.argmax(1), model._lead(score), part.fits(score)
                mixed = np.logical_or.reduceat((best != label) & (lead >= CLEAR), part.heads)[part.text]
                seen = fits & (best == label) & (chars >= TOLD) & (words > 1)
                row = np.repeat(each, part.count)
                kept = (fits & (score.max(1) - score[each, label] < CLEAR))[row] & ~np.fromiter(map(_side_of_word, part.flat), bool, len(part.flat))
                cost, n, _ = half._scores(list(compress(part.flat, kept.tolist())), np.bincount(row[kept], minlength=len(each)))
                rest = n > TOLD
                at = -score[each, label] / chars
                ahead = np.log(lead + 1e-3)
                for kind, who, value, steps in (
                    ("rest", rest, -cost[each, label] / np.maximum(n, 1), COST_STEPS), ("seen", seen, at, COST_STEPS),
                    ("right", fits & ~mixed & (best == label), ahead, LEAD_STEPS), ("wrong", fits & ~mixed & (best != label), ahead, LEAD_STEPS),
                ):
                    key, many = np.unique((label[who] << 40) + np.rint(value[who] * steps).astype(np.int64) + (1 << 39), return_counts=True)
                    for j, x, m in zip((key >> 40).tolist(), ((key & (1 << 40) - 1) - (1 << 39)).tolist(), many.tolist()):
                        tally[model.names[j], kind, x] += m
        yield _batch([*([k[i] for k in tally] for i in range(3)), list(tally.values())], schema)

    return run, schema, ["l", "kind", "at"]


def _labelled(df: DataFrame, text_col: str, label_col: str) -> DataFrame:
    return df.select(label_language(F.col(label_col)).alias("l"), F.col(text_col).alias("t")).where("t is not null and l is not null")


def fitted(df: DataFrame, text_col: str = "text", label_col: str = "language") -> Tongues:
    """The models of all labelled texts of a table.

    Three passes; the driver gets the distinct n-grams with their counts and the tallies of costs, no texts.
    """
    rows = spread(_labelled(df, text_col, label_col))

    def gathered(*passes: Pass) -> pa.Table:
        found = rows
        for run, schema, keys in passes:
            found = found.mapInArrow(run, schema)
            found = found.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in found.columns if c not in keys))
        return found.toArrow()

    model = Tongues({})
    model._fit(gathered)
    return model


def samples(df: DataFrame, text_col: str = "text", label_col: str = "language") -> dict[str, list[str]]:
    """All labelled texts by language, for tables that fit in memory; `fitted` counts tables of any size where they lie."""
    out: dict[str, list[str]] = {}
    for r in _labelled(df, text_col, label_col).collect():
        out.setdefault(r["l"], []).append(r["t"])
    return out


def _rows(model: Tongues, skip: residue.Model | None, name: str):
    """Rows (tab_name, row_id, lang) of the cases among texts; with `skip` for pages, whose main language alone counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, labels, texts = (b.column(c).to_pylist() for c in ("id", "label", "text"))
            if skip:
                pages, marks = texts, skip.lines.furniture(texts)
                texts = ["\n".join(x for x, f in zip(t.split("\n"), m) if not f) for t, m in zip(pages, marks)]
            read = model.read([segments(t) for t in texts])
            rows: list[tuple[int, str]] = []
            for k, (i, label, found) in enumerate(zip(ids, labels, read)):
                weight: Counter[str] = Counter()
                segs = segments(texts[k]) if skip else ()
                for at, lang, _ in found:
                    if lang != UNKNOWN:
                        weight[lang] += len(segs[at]) if skip else 1
                langs = [weight.most_common(1)[0][0]] if skip and weight else list(weight)
                if langs and (label is None or len(langs) > 1 or langs[0] != label):
                    rows += [(k, x) for x in langs]
            if skip and rows:
                case = skip.judge([pages[k] for k, _ in rows], [marks[k] for k, _ in rows])
                rows = [r for r, c in zip(rows, case) if not c]
            yield pa.record_batch({
                "tab_name": pa.array([name] * len(rows), pa.string()),
                "row_id": pa.array([ids[k] for k, _ in rows], pa.int64()),
                "lang": pa.array([x for _, x in rows], pa.string()),
            })

    return run


SCHEMA = "tab_name string, row_id long, lang string"


def _texts(df: DataFrame, id_col: str, label_col: str, text_col: str) -> DataFrame:
    rows = df.select(F.col(id_col).cast("long").alias("id"), label_language(F.col(label_col)).alias("label"), F.col(text_col).alias("text"))
    return spread(rows.where("id is not null and text is not null"))


def mislabelled(df: DataFrame, model: Tongues, name: str, id_col: str = "example_id", label_col: str = "language", text_col: str = "text") -> DataFrame:
    """(tab_name, row_id, lang): one row per language of each text whose label is missing, wrong, or one of several.

    Null ids and texts, and texts without letters, give no row; any spelling of a right label is right; repeated rows
    come out repeated; an empty table gives an empty result. One pass, no shuffle.
    """
    return _texts(df, id_col, label_col, text_col).mapInArrow(_rows(model, None, name), SCHEMA)


def mislabelled_pages(
    df: DataFrame, model: Tongues, skip: residue.Model, name: str, id_col: str = "page_id", label_col: str = "website_language",
    text_col: str = "website_text", status_col: str = "website_text_status",
) -> DataFrame:
    """As `mislabelled`, by the main language of the main body of pages of status `success` that are no residue."""
    return _texts(df.where(F.col(status_col) == "success"), id_col, label_col, text_col).mapInArrow(_rows(model, skip, name), SCHEMA)


def _whole(split: list[str], found: list[tuple[int, str, float]], body: list[bool]) -> tuple[str | None, float]:
    """The language in which most letters of a text's body are written, and its share of them by confidence; of all lines where there is no body."""
    size = {k: sum(map(len, WORDS.findall(split[k]))) for k, _, _ in found}
    kept = [x for x in found if body[x[0]]] or found
    weight: Counter[str] = Counter()
    for k, lang, _ in kept:
        weight[lang] += size[k]
    if not weight:
        return None, 0.0
    lang = weight.most_common(1)[0][0]
    return lang, sum(size[k] * c for k, x, c in kept if x == lang) / max(1, sum(size[k] for k, _, _ in kept))


def _read(model: Tongues, whole: bool, pages: Lines | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column("id").to_pylist(), b.column("text").to_pylist()
            split, bodies = [segments(t) for t in texts], []
            if pages:  # by lines, as furniture is told by lines
                lines = [[(segments(x), f) for x, f in zip(t.split("\n"), m)] for t, m in zip(texts, pages.furniture(texts))]
                split = [[s for x, _ in ls for s in x] for ls in lines]
                bodies = [[not f for x, f in ls for _ in x] for ls in lines]
            rows: list[tuple[int, int | None, str | None, str | None, float]] = []
            for t, (i, s, found) in enumerate(zip(ids, split, model.read(split))):
                if whole:
                    rows.append((i, None, None, *_whole(s, found, bodies[t] if pages else [True] * len(s))))
                rows += [(i, k, s[k], lang, conf) for k, lang, conf in found]
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string()), pa.array(cols[4], pa.float64())], ["id", "segment_no", "segment", "lang", "confidence"])

    return run


def segment_languages(df: DataFrame, model: Tongues, id_col: str = "example_id", text_col: str = "text", whole: bool = False, pages: Lines | None = None) -> DataFrame:
    """(id, segment_no, segment, lang, confidence): every segment with letters, its language and how sure that is.

    A segment that no language fits has the language `und`. With `whole` each text that is not null has a row of
    its own besides, whose segment_no and segment are null; with `pages`, a classifier of lines, it goes by the main body. A text without letters
    has language null and confidence 0.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")
    return spread(rows).mapInArrow(_read(model, whole, pages), "id long, segment_no int, segment string, lang string, confidence double")
