"""Word shingles of whole texts as 64-bit numbers, vectorised with numpy.

Words are [^\\x20\\x09-\\x0D]+ after lower-casing A-Z.  Words are hashed byte by
byte with a polynomial and mixed, a shingle is a mixed combination of its
words' hashes; no Python object is made for a word.
"""

from __future__ import annotations

import numpy as np

CHUNK_BYTES = 1 << 16  # its arrays stay in a processor's cache
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_CODE = _LOWER.astype(np.uint64) + np.uint64(1)
_CODE[_BLANK] = 0
_BASE = 0x9E3779B97F4A7C15
_powers = np.ones((2, 1), dtype=np.uint64)


def _power_table(n: int) -> np.ndarray:
    """Powers of the base and of its inverse, modulo 2**64."""
    global _powers
    if n > _powers.shape[1]:
        grown = np.empty((2, max(n, 64)), dtype=np.uint64)
        grown[0], grown[1], grown[:, 0] = _BASE, pow(_BASE, -1, 1 << 64), 1
        with np.errstate(over="ignore"):
            _powers = np.multiply.accumulate(grown, axis=1)
    return _powers


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _words_of(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte's place of every word of a byte buffer."""
    blank = np.ones(len(buf) + 2, dtype=bool)
    blank[1:-1] = _BLANK[buf]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, length = edges[::2], np.diff(edges)[::2]
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    powers, inverse = _power_table(len(buf))
    with np.errstate(over="ignore"):
        # powers of the place in the buffer, so blanks count nothing; then of the place in the word
        value = _CODE[buf] * powers[:len(buf)]
        return mix64(np.add.reduceat(value, starts) * inverse[starts] + length.astype(np.uint64)), starts


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and byte places of the words of data.  Long data are cut at
    white space, so memory follows CHUNK_BYTES or the longest word."""
    buf = np.frombuffer(data, dtype=np.uint8)
    if len(buf) <= CHUNK_BYTES:
        return _words_of(buf)
    hashes, places, start = [], [], 0
    while start < len(buf):
        end, step = min(len(buf), start + CHUNK_BYTES), 256
        while end < len(buf):
            gap = np.flatnonzero(_BLANK[buf[end:end + step]])
            if len(gap):
                end += int(gap[0])
                break
            end, step = min(len(buf), end + step), 4 * step
        h, p = _words_of(buf[start:end])
        hashes.append(h)
        places.append(p + start)
        start = end
    return np.concatenate(hashes), np.concatenate(places)


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Per text the sorted distinct shingles of `size` words; a text with fewer
    words is one shingle, a text without words (or NULL) has none."""
    out: list[np.ndarray] = []
    group: list[bytes] = []
    held = 0

    def flush() -> None:
        nonlocal group, held
        if not group:
            return
        hashes, places = word_hashes(b" ".join(group))
        limits = np.cumsum([len(g) + 1 for g in group])
        cut = np.searchsorted(places, limits)
        low = 0
        for high in cut:
            out.append(_shingles(hashes[low:high], size))
            low = high
        group, held = [], 0

    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        group.append(data)
        held += len(data)
        if held > CHUNK_BYTES:
            flush()
    flush()
    return out


def _shingles(words: np.ndarray, size: int) -> np.ndarray:
    n = len(words)
    if not n:
        return words
    span = min(size, n)
    with np.errstate(over="ignore"):
        total = np.full(n - span + 1, np.uint64(span), dtype=np.uint64)
        for k in range(span):
            total = mix64(total * _BASE + words[k:n - span + 1 + k])
    return np.unique(total)
