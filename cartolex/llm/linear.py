"""A regularised linear classifier on hashed n-grams, fitted with numpy on a bounded sample."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\W\d_]+|\d+")
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Hasher:
    """Features of many texts at once: hashed runs of one to three words, with numbers as one word, and extra flags."""

    def __init__(self, bits: int = 16, flags: int = 0) -> None:
        self.bits, self.flags = bits, flags
        self.width = (1 << bits) + flags
        self.known: dict[str, int] = {}

    def _ids(self, words: list[str]) -> np.ndarray:
        if len(self.known) > 500_000:
            self.known.clear()
        known, out = self.known, []
        for w in words:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh64_intdigest("0" if w[0].isdigit() else w)
            out.append(h)
        return np.array(out, np.uint64)

    def __call__(self, texts: list[str], flags: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, feature, value) triples; the n-grams of a row have equal values whose squares sum to one."""
        split = [WORD.findall(t.lower()) for t in texts]
        size = np.array([len(s) for s in split], np.int64)
        w = self._ids([x for s in split for x in s])
        at = np.repeat(np.arange(len(texts)), size)
        rows, cols = [at], [w]
        h = w
        for k in (1, 2):
            if len(w) <= k:
                break
            h = (h[:-1] ^ (h[:-1] >> np.uint64(31))) * _A + w[k:] * _B
            inside = at[: len(h)] == at[k:]
            rows.append(at[: len(h)][inside])
            cols.append((h ^ np.uint64(k * 0x1234567))[inside])
        row, col = np.concatenate(rows), np.concatenate(cols)
        col = ((col * _A) >> np.uint64(64 - self.bits)).astype(np.int64)
        value = (1 / np.sqrt(np.maximum(1, np.bincount(row, minlength=len(texts)))))[row]
        if flags is not None and self.flags:
            r, c = np.nonzero(flags)
            row, col, value = np.concatenate((row, r)), np.concatenate((col, c + (1 << self.bits))), np.concatenate((value, flags[r, c].astype(float)))
        return row, col, value


def scores(weights: np.ndarray, bias: float, n: int, triples: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    row, col, value = triples
    return bias + np.bincount(row, weights=weights[col] * value, minlength=n)


def fit(
    triples: tuple[np.ndarray, np.ndarray, np.ndarray], labels: np.ndarray, width: int, prior: np.ndarray | None = None,
    penalty: float = 2e-5, rounds: int = 120, rate: float = 0.5,
) -> tuple[np.ndarray, float]:
    """Logistic regression with classes of equal weight, pulled towards `prior`; adaptive full gradients."""
    row, col, value = triples
    # Only features that the sample has are iterated; the others keep their start.
    used, col = np.unique(col, return_inverse=True)
    out = np.zeros(width) if prior is None else prior.copy()
    start, b = out[used], 0.0
    w, width = start.copy(), len(used)
    n1, n0 = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))
    weight = np.where(labels == 1, 0.5 / n1, 0.5 / n0)
    seen, seen_b = np.full(width, 1e-8), 1e-8
    for _ in range(rounds):
        z = scores(w, b, len(labels), (row, col, value))
        g = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels) * weight
        grad = np.bincount(col, weights=g[row] * value, minlength=width) + penalty * (w - start)
        gb = g.sum()
        seen += grad**2
        seen_b += gb**2
        w -= rate * grad / np.sqrt(seen)
        b -= rate * gb / np.sqrt(seen_b)
    out[used] = w
    return out, b
