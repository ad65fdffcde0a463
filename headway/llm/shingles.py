"""Hashed words and word shingles of a text, by arrays over its bytes."""

from __future__ import annotations

import numpy as np

WORDS_PER_SHINGLE = 5
#: A-Z to a-z, other ASCII but letters and digits to blank; bytes from 0x80 are word bytes.
FOLDED = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)
_BASE = 0x9E3779B97F4A7C15 | 1
#: Bytes hashed at a time.
SPAN_BYTES = 1 << 20
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made.append(np.multiply.accumulate(steps))
        if size > 1 << 22:
            return made[0], made[1]
        _powers = (made[0], made[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, which are in order and do not overlap."""
    out = np.zeros(len(start), np.uint64)
    k = 0
    while k < len(start):
        stop = max(k + 1, int(np.searchsorted(end, start[k] + SPAN_BYTES)))
        first, last = int(start[k]), int(end[stop - 1])
        part = data[first:last]
        up, down = _power_tables(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(mix(part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        s, e = start[k:stop] - first, end[k:stop] - first
        out[k:stop] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        k = stop
    return out


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text, A-Z lower-cased."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(FOLDED), np.uint8)
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = data != 32
    edge = np.diff(inside)
    return hash_spans(data, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))


def shingle_set(text: str | None, k: int = WORDS_PER_SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of each ``k`` words in a row; of all words where there are fewer."""
    w = word_hashes(text)
    if not len(w):
        return w
    k = min(k, len(w))
    s = w[: len(w) - k + 1].copy()
    for j in range(1, k):
        s = mix(s) + w[j : len(w) - k + 1 + j]
    return np.unique(mix(s))
