"""Word and shingle hashes of a text, vectorised over its bytes."""

from __future__ import annotations

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes that part words: blank and the controls 0x09 to 0x0D.
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], dtype=np.uint64)
_powers = np.ones(1, dtype=np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, _BASE, dtype=np.uint64)]), dtype=np.uint64)
    return _powers


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a text, and the bytes at which they begin."""
    data = _LOWER[np.frombuffer(text, np.uint8)]
    solid = ~_BLANK[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8)))
    if not len(edge):
        return np.empty(0, np.uint64), edge
    lengths = edge[1::2] - edge[::2]
    first = np.cumsum(lengths) - lengths
    offset = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    powers = _powers_to(int(lengths.max()))
    terms = (data[solid].astype(np.uint64) + np.uint64(1)) * powers[offset]
    return mix64(np.add.reduceat(terms, first) + lengths.astype(np.uint64) * _BASE), edge[::2]


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word; words are parted by blanks, A-Z count as a-z."""
    return _hashed(text.encode("utf-8", "surrogatepass"))[0] if text else np.empty(0, np.uint64)


def word_hashes_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of all texts, one text behind the other, and the number of words of each."""
    data = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    begin = np.cumsum([0, *(len(d) + 1 for d in data)])[:-1]
    words, at = _hashed(b" ".join(data))
    return words, np.bincount(np.searchsorted(begin, at, "right") - 1, minlength=len(texts))


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of ``k`` words, by position; none if there are fewer."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = words[:n] * _SLOTS[0]
    for j in range(1, k):
        total = total + words[j : j + n] * _SLOTS[j]
    return mix64(total)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct hashes of ``k``-word shingles; a shorter text is one shingle, an empty one none."""
    words = word_hashes(text)
    if 0 < len(words) < k:
        words = np.concatenate([words, np.zeros(k - len(words), np.uint64)])
    return np.unique(run_hashes(words, k))
