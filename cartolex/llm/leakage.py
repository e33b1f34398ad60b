"""Problem 9: passages of evaluation items inside corpus documents.

Q-gram lemma: a region of at least L characters of an item that occurs in a document with at most k edits shares
at least L + 1 - q(k + 1) of its q-grams with it, all within a band of diagonals. Hits are counted in overlapping
diagonal bands, regions that reach the bound are verified by banded alignment, and the words of the verified region are
compared exactly where an exact run is asked for. Few items go to every task as one index that documents stream past; more
of them meet the documents in a shuffle, by the q-grams that windows of both select alike.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.runtime import materialise, spread
from ..functions.words import word_string
from .overlap import slices

BITS = 22
LONGEST = 24
#: Characters of items up to which all of them are one index in every task, and characters of text that a task takes at once.
FEW_CHARS, CHARS = 4_000_000, 2_000_000
_MUL = np.uint64(0x9E3779B97F4A7C15)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """Digests of all runs of q characters, by doubling."""
    h, have, out, done = codes.astype(np.uint64) * _MUL, 1, None, 0
    while True:
        if q & have:
            if out is None:
                out, done = h, have
            else:
                m = len(h) - done
                out = ((out[:m] ^ (out[:m] >> np.uint64(31))) * _MUL + h[done : done + m]) if m > 0 else out[:0]
                done += have
        if done == q:
            n = max(0, len(codes) - q + 1)
            out = out[:n]
            return out ^ (out >> np.uint64(33))
        m = len(h) - have
        h = ((h[:m] ^ (h[:m] >> np.uint64(29))) * _MUL + h[have : have + m] * np.uint64(0xD6E8FEB86659FD93)) if m > 0 else h[:0]
        have *= 2


def _least_chars(norms: list[str], words: int) -> int:
    """Characters of the shortest run of `words` words in any item: every region sought is as long."""
    least = 1 << 30
    for t in norms:
        ends = np.array([m.end() for m in re.finditer(r"\S+", t)], np.int64)
        starts = np.array([m.start() for m in re.finditer(r"\S+", t)], np.int64)
        if len(ends) >= words:
            least = min(least, int((ends[words - 1 :] - starts[: len(starts) - words + 1]).min()))
    return least


class ItemIndex:
    """Q-grams of a block of items: digests in order with the items and places that hold them, and a bitmap before."""

    def __init__(self, items: list[tuple[int, str]], words: int, edits: int, length: int | None = None) -> None:
        self.ids = np.array([i for i, _ in items], np.int64)
        self.norms = [t for _, t in items]
        self.words, self.edits = words, edits
        self.length = _least_chars(self.norms, words) if length is None else length
        self.usable = self.length < 1 << 30
        if not self.usable:
            return
        # The longest q whose bound still is two or more; with edits a shorter one, whose bound is worth counting up to.
        self.q = max(1, min((self.length - 1) // (edits + 1), LONGEST))
        self.bound = max(1, self.length + 1 - self.q * (edits + 1))
        parts = [(_grams(_codes(t), self.q), k) for k, t in enumerate(self.norms)]
        gram = np.concatenate([g for g, _ in parts])
        item = np.concatenate([np.full(len(g), k, np.int64) for g, k in parts])
        place = np.concatenate([np.arange(len(g)) for g, _ in parts])
        order = np.argsort(gram, kind="stable")
        gram, self.item, self.place = gram[order], item[order], place[order]
        self.gram, self.first = np.unique(gram, return_index=True)
        self.count = np.diff(np.append(self.first, len(gram)))
        self.bitmap = np.zeros(1 << BITS, bool)
        self.bitmap[(self.gram >> np.uint64(64 - BITS)).astype(np.int64)] = True
        self.runs = [self._runs(t.split(" ")) for t in self.norms]

    def _runs(self, w: list[str]) -> set[tuple[str, ...]]:
        return {tuple(w[i : i + self.words]) for i in range(len(w) - self.words + 1)}

    def candidates(self, texts: list[str], exact: bool = False) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(text, item, places in the text, places in the item): the hits of every band of a text that reach the bound.

        With `exact`, of bands that also have as many hits in a row on one diagonal as an untouched passage has.
        """
        if not self.usable or not texts:
            return []
        sizes = np.array([len(t) for t in texts], np.int64)
        start = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        codes = _codes("\n".join(texts))
        g = _grams(codes, self.q)
        at = np.flatnonzero(self.bitmap[(g >> np.uint64(64 - BITS)).astype(np.int64)])
        if not len(at) or not len(self.gram):
            return []
        k = np.minimum(np.searchsorted(self.gram, g[at]), len(self.gram) - 1)
        same = self.gram[k] == g[at]
        at, k = at[same], k[same]
        out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        # Hits are unfolded in slices of bounded size that end at document ends.
        doc = np.searchsorted(start, at, side="right") - 1
        n = self.count[k]
        cum = np.cumsum(n)
        lo = 0
        while lo < len(at):
            hi = int(np.searchsorted(cum, (cum[lo - 1] if lo else 0) + 500_000, side="right"))
            hi = max(hi, lo + 1)
            if hi < len(at):
                back = int(np.searchsorted(doc, doc[hi], side="left"))
                hi = back if back > lo else int(np.searchsorted(doc, doc[lo], side="right"))
            a, kk, nn = at[lo:hi], k[lo:hi], n[lo:hi]
            rep = np.repeat(np.arange(len(a)), nn)
            off = np.arange(len(rep)) - np.repeat(np.cumsum(nn) - nn, nn)
            src = self.first[kk][rep] + off
            d, it = doc[lo:hi][rep], self.item[src]
            pos = a[rep] - start[d]
            diag = pos - self.place[src] + (1 << 20)
            width = max(1, 2 * self.edits)
            # bands of two widths that overlap by one; an untouched passage keeps to one diagonal, which lies in either
            for shift in (0,) if exact else (0, width):
                band = (diag + shift) // (2 * width)
                key = np.lexsort((pos, diag, band, it, d))
                kd, ki, kb, kg, kp = d[key], it[key], band[key], diag[key], pos[key]
                new = np.ones(len(key), bool)
                new[1:] = (kd[1:] != kd[:-1]) | (ki[1:] != ki[:-1]) | (kb[1:] != kb[:-1])
                head = np.flatnonzero(new)
                hits = np.diff(np.append(head, len(key)))
                good = hits >= self.bound
                if exact:
                    cut = new.copy()
                    cut[1:] |= (kg[1:] != kg[:-1]) | (kp[1:] != kp[:-1] + 1)
                    run = np.cumsum(cut) - 1
                    good &= np.maximum.reduceat(np.bincount(run)[run], head) >= self.length + 1 - self.q
                for h, c in zip(head[good], hits[good]):
                    mine = key[h : h + c]
                    mine = mine[np.argsort(pos[mine], kind="stable")]
                    out.append((int(kd[h]), int(ki[h]), pos[mine], self.place[src[mine]]))
            lo = hi
        return out

    def align(self, item: str, region: str, place: int, most: int | None = None) -> int:
        """Edits between the region and the item about `place`, free at the item's ends; `most` + 1 where there are more.

        A band of diagonals, each followed from one mismatch to the next: the furthest place that every number of edits reaches.
        """
        slack = 2 * self.edits + 1
        low = place - slack
        part = item[max(0, low) : place + len(region) + slack]
        if region in part:
            return 0
        most = len(region) if most is None else most
        a, n = _codes(region), len(region)
        far = np.full(n + 5 * slack + 2, 0xFFFFFFFF, np.uint32)  # diagonals from -slack to 2 x slack, padded on both sides
        b = _codes(part)[: len(far) - slack]
        far[slack : slack + len(b)] = b
        width = 4 * slack + 1
        breaks = [np.flatnonzero(far[d : d + n] != a).tolist() + [n] for d in range(width)]
        reach = [-1] * width
        for e in range(min(most, n) + 1):
            now = []
            for d in range(width):
                at = 0 if e == 0 and slack <= d <= 3 * slack else -1
                if e:
                    at = reach[d] + 1 if reach[d] >= 0 else -1  # another character
                    if d and reach[d - 1] >= 0:  # one that only the item has
                        at = max(at, reach[d - 1])
                    if d + 1 < width and reach[d + 1] >= 0:  # one that only the region has
                        at = max(at, reach[d + 1] + 1)
                if at >= 0:
                    at = n if at >= n else breaks[d][bisect_left(breaks[d], at)]
                    if at >= n:
                        return e
                now.append(at)
            reach = now
        return min(most, n) + 1

    def regions(self, item: str, text: str, at: np.ndarray, place: np.ndarray) -> list[tuple[int, int]]:
        """(characters, edits) of the regions about the hits of one band that are within the budget.

        The whole stretch of hits where it is; else every piece between gaps wider than the edits of one passage leave,
        and within a piece that is not, the stretches whose every window of the passage length is.
        """
        out = []

        def fits(lo: int, hi: int, f: int) -> bool:
            most = self.edits * max(1, (hi - lo) // self.length)
            e = self.align(item, text[lo:hi], f, most)
            if hi - lo >= self.length - self.q * self.edits and e <= most:
                out.append((hi - lo, e))
                return True
            return False

        if fits(int(at[0]), int(at[-1]) + self.q, int(place[0])):
            return out
        for piece in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) > (self.q + 1) * self.edits + 1) + 1):
            a, f = at[piece], place[piece]
            if len(a) < self.bound:
                continue
            lo, hi = int(a[0]), int(a[-1]) + self.q
            if len(piece) < len(at) and hi - lo >= self.length and fits(lo, hi, int(f[0])):
                continue
            # windows that may begin before the first hit, since an edit hides the hits about it
            first = np.arange(max(0, int(a[0]) - self.q), min(int(a[-1]) + self.q, len(text) - self.length) + 1)
            inside = np.searchsorted(a, first + self.length - self.q, side="right") - np.searchsorted(a, first)
            first = first[inside >= self.bound]
            if not len(first):
                continue
            k = np.searchsorted(a, first)
            edits = self._windows(item, text, first, f[k] - a[k] + first)
            good, edits = first[edits <= self.edits], edits[edits <= self.edits]
            for run in np.split(np.arange(len(good)), np.flatnonzero(np.diff(good) > 1) + 1):
                if len(run):
                    lo, hi = int(good[run[0]]), int(good[run[-1]]) + self.length
                    k = min(int(np.searchsorted(a, lo)), len(a) - 1)
                    out.append((hi - lo, max(int(edits[run].max()), self.align(item, text[lo:hi], max(0, int(f[k] - a[k]) + lo)))))
        return out

    def _windows(self, item: str, text: str, first: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Edits of each window of the passage length against the item about its place; alignment in a band, all windows at once."""
        slack = 5 * self.edits
        a, b = _codes(text), np.append(_codes(item), np.uint32(0xFFFFFFFF))
        shift = np.arange(-slack, slack + 1)
        cost = np.zeros((len(first), len(shift)), np.int64)
        for i in range(self.length):
            j = place[:, None] + i + shift
            differs = b[np.where((j >= 0) & (j < len(b) - 1), j, len(b) - 1)] != a[first + i][:, None]
            now = cost + differs
            now[:, :-1] = np.minimum(now[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(now - shift, axis=1) + shift
        return cost.min(1)

    def exact(self, item: int, text_words: list[str]) -> int:
        """Length of the longest run of words of the text that stands in the item, 0 if under `words`."""
        runs, best, now = self.runs[item], 0, 0
        for i in range(len(text_words) - self.words + 1):
            now = now + 1 if tuple(text_words[i : i + self.words]) in runs else 0
            best = max(best, now)
        return best + self.words - 1 if best else 0


    def find(self, texts: list[str], exact: bool, wanted: set[tuple[int, int]] | None = None) -> dict[tuple[int, int], tuple[int, int]]:
        """{(text, item): (size, edits)} of the texts' largest verified regions, for the pairs `wanted` where these are given."""
        best: dict[tuple[int, int], tuple[int, int]] = {}
        by: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for d, it, at, place in self.candidates(texts, exact):
            if wanted is None or (d, it) in wanted:
                by.setdefault((d, it), []).append((at, place))
        for (d, it), spans in by.items():
            found = [r for at, place in spans for r in self.regions(self.norms[it], texts[d], at, place)]
            if not found:
                continue
            if exact:
                # the exact check of what alignment let through, widened to the words at its ends
                lo, hi = min(int(at[0]) for at, _ in spans), max(int(at[-1]) for at, _ in spans) + self.q
                lo = texts[d].rfind(" ", 0, lo + 1) + 1
                hi = (texts[d].find(" ", max(0, hi - 1)) + 1 or len(texts[d]) + 1) - 1
                n = self.exact(it, texts[d][lo:hi].split(" "))
                if n:
                    best[d, it] = (n, 0)
            else:
                best[d, it] = max(found, key=lambda x: (x[0], -x[1]))
        return best


SCHEMA = "doc_id long, item_id long, size long, edits long"


def _batch(ids: np.ndarray, items: np.ndarray, best: dict[tuple[int, int], tuple[int, int]]) -> pa.RecordBatch:
    keys = list(best)
    return pa.record_batch({
        "doc_id": pa.array(ids[[d for d, _ in keys]] if keys else [], pa.int64()), "item_id": pa.array(items[[i for _, i in keys]] if keys else [], pa.int64()),
        "size": pa.array([best[k][0] for k in keys], pa.int64()), "edits": pa.array([best[k][1] for k in keys], pa.int64()),
    })


def _scan(index: ItemIndex, exact: bool):
    """Documents past one index of all items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column("doc").to_numpy(), b.column("norm").to_pylist()
            for lo, hi in slices(texts, CHARS):
                yield _batch(ids[lo:hi], index.ids, index.find(texts[lo:hi], exact))

    return run


def _lengths(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch({"least": pa.array([_least_chars(b.column("t").to_pylist(), words)], pa.int64())})

    return run


def _selected(key: str, text: str, q: int, window: int):
    """(key, gram): distinct q-grams of each text that have the smallest digest of some window of `window` neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts = b.column(key).to_numpy(), b.column(text).to_pylist()
            for lo, hi in slices(texts, CHARS):
                part = texts[lo:hi]
                start = np.concatenate(([0], np.cumsum([len(t) + 1 for t in part])[:-1]))
                g = _grams(_codes("\n".join(part)), q)
                if len(g) < window:
                    continue
                at = np.unique(np.lib.stride_tricks.sliding_window_view(g, window).argmin(1) + np.arange(len(g) - window + 1))
                own = keys[lo:hi][np.searchsorted(start, at, side="right") - 1]
                rows = pa.table({key: pa.array(own), "gram": pa.array(g[at].view(np.int64))}).group_by([key, "gram"]).aggregate([])
                yield from rows.select([key, "gram"]).to_batches()

    return run


def _verify(words: int, edits: int, exact: bool, length: int):
    """Candidate pairs with both texts: an index of the items of a slice, asked for the slice's own pairs only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, item, norms, texts = (b.column(c).to_pylist() for c in ("doc", "i", "norm", "t"))
            for lo, hi in slices([x + y for x, y in zip(norms, texts)], CHARS):
                known = sorted(set(zip(item[lo:hi], texts[lo:hi])))
                at = {x: k for k, x in enumerate(known)}
                index = ItemIndex(known, words, edits, length)
                wanted = {(k - lo, at[item[k], texts[k]]) for k in range(lo, hi)}
                yield _batch(np.array(doc[lo:hi], np.int64), index.ids, index.find(norms[lo:hi], exact, wanted))

    return run


def leaked(
    documents: DataFrame, items: DataFrame, doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", words: int = 12, edits: int = 1, exact: bool = True, few: int = 2000,
) -> DataFrame:
    """(doc_id, item_id, size, edits): documents with a passage of an item.

    A region as long in characters as the shortest run of `words` words of any item, with at most `edits` edits per that
    length, found by counting q-grams in bands and measured by alignment; what stands between two such regions does not
    count against them. `exact`: the region also holds at least `words` consecutive words of the item; size is then the
    longest such run in words and edits 0.
    Up to `few` items and FEW_CHARS characters of them go to every task as one index; more are joined with the documents by
    selected q-grams: a region with that few edits has an untouched piece, and any window of a piece selects the same q-gram
    on both sides, so no region is missed. Either way takes one pass over the documents and gives the same rows.
    Null ids or texts, and items of fewer than `words` words, give no row; repeated rows of a document give one row
    each; items of equal text are all named; an empty table gives an empty result.
    """
    edits = max(1, edits)
    known = items.select(F.col(item_col).cast("long").alias("i"), word_string(F.col(item_text_col)).alias("t")).where("i is not null and t is not null").distinct()
    docs = documents.select(F.col(doc_col).cast("long").alias("doc"), word_string(F.col(text_col)).alias("norm")).where("doc is not null and norm != ''")
    size = known.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("chars")).first()
    if size["n"] <= few and size["chars"] <= FEW_CHARS:
        index = ItemIndex(sorted((r["i"], r["t"]) for r in known.collect()), words, edits)
        return spread(docs).mapInArrow(_scan(index, exact), SCHEMA)
    length = known.mapInArrow(_lengths(words), "least long").agg(F.min("least")).first()[0]
    if length is None or length >= 1 << 30:  # no item is long enough
        return documents.sparkSession.createDataFrame([], SCHEMA)
    piece = max(1, (length - edits) // (edits + 1))
    q = max(1, (piece + 1) // 2)
    window = piece - q + 1
    docs, known = materialise(docs), materialise(known)
    of_docs, of_items = (x.mapInArrow(_selected(k, t, q, window), f"{k} long, gram long") for x, k, t in ((docs, "doc", "norm"), (known, "i", "t")))
    met = of_docs.join(of_items, "gram").select("doc", "i").distinct()
    both = met.join(docs, "doc").join(known, "i").select("doc", "i", "norm", "t")
    return both.mapInArrow(_verify(words, edits, exact, length), SCHEMA)
