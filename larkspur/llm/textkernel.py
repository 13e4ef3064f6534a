"""Vectorised word and shingle hashing over Arrow string columns.

A word is a maximal run of bytes outside ``0x20 0x09-0x0D`` in the UTF-8 text,
with A-Z lower-cased.  Words are hashed with a random polynomial modulo 2**64
and mixed; nothing is allocated per word.  Work is done in chunks cut between
words, so the scratch arrays stay small for texts of any length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.Generator(np.random.PCG64(0x5EED))
_LETTER = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B]  # A-Z count as a-z
_LANES = _rng.integers(1, 1 << 63, size=8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1, 1 << 62)) * 4 + 3
_BASE_INV = pow(_BASE, -1, 1 << 64)

_powers: dict[str, np.ndarray] = {}


def _table(name: str, base: int, n: int) -> np.ndarray:
    """``base**i`` modulo 2**64 for i < n, kept for the life of the worker."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, CHUNK + 1)
        have = np.full(size, base & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 2 * CHUNK:
            _powers[name] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def utf8_parts(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, dtype=np.uint8)[lo:hi] if data is not None and hi > lo else np.zeros(0, dtype=np.uint8)
    return raw, offsets - lo


def hash_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and each text's word offsets (n + 1)."""
    n = len(raw)
    hashes, starts = [], []
    breaks = np.unique(offsets)
    at = 0
    while at < n:
        end = min(n, at + CHUNK)
        if end < n:
            cut = end
            tail = np.flatnonzero(_SPACE[raw[at:end]])
            k = np.searchsorted(breaks, end, side="right") - 1
            cut = max(at + int(tail[-1]) + 1 if len(tail) else at, int(breaks[k]))
            while cut <= at:  # one word longer than the chunk
                more = min(n, end + CHUNK)
                tail = np.flatnonzero(_SPACE[raw[end:more]])
                k = np.searchsorted(breaks, end, side="right")
                stop = int(breaks[k]) if k < len(breaks) else n
                cut = min(end + int(tail[0]) if len(tail) else (n if more == n else at), stop if stop <= more else n + 1)
                if cut > n:
                    cut = at
                end = more
            end = cut
        part = raw[at:end]
        space = _SPACE[part]
        inside = ~space
        first = inside.copy()
        first[1:] &= space[:-1]
        lo, hi = np.searchsorted(breaks, [at, end])
        inner = breaks[lo:hi] - at
        first[inner] = inside[inner]
        last = inside.copy()
        last[:-1] &= space[1:]
        inner = inner[inner > 0] - 1
        last[inner] = inside[inner]
        s = np.flatnonzero(first)
        e = np.flatnonzero(last) + 1
        value = _LETTER[part]
        value *= _table("p", _BASE, len(part))[: len(part)]
        total = np.empty(len(part) + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(value, out=total[1:])
        h = (total[e] - total[s]) * _table("i", _BASE_INV, len(part))[s]
        hashes.append(mix(h + (e - s).astype(np.uint64) * _LANES[7]))
        starts.append(s + at)
        at = end
    h = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    s = np.concatenate(starts) if starts else np.zeros(0, dtype=np.int64)
    return h, np.searchsorted(s, offsets)


def hash_grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word windows starting at each word (length - k + 1 of them)."""
    m = len(words) - k + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = words[:m] * _LANES[0]
    for i in range(1, k):
        total += mix(words[i : i + m] + _LANES[i]) * _LANES[i]
    return mix(total)


def shingle_sets(column, k: int = 5):
    """Yields each text's sorted distinct k-word shingle hashes (48 bits, uint64).

    A text with fewer than k words has its whole sequence as one shingle; a
    text without words has none.
    """
    raw, offsets = utf8_parts(column)
    words, bounds = hash_words(raw, offsets)
    grams = hash_grams(words, k) >> np.uint64(16)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= k:
            g = np.sort(grams[a : b - k + 1])
            keep = np.empty(len(g), dtype=bool)
            keep[0] = True
            np.not_equal(g[1:], g[:-1], out=keep[1:])
            yield g[keep]
        elif b > a:
            yield hash_grams(words[a:b], b - a) + np.uint64(b - a) >> np.uint64(16)
        else:
            yield grams[:0]
