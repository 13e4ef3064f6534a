"""Counting of terms in numpy, packed by length.

A term is a maximal run of letters A-Z, a-z and bytes above 127; A-Z count as a-z.
Terms of up to 8 bytes become one big-endian uint64, of up to 16 two; these are sorted
by radix passes over 16-bit digits and counted as runs.  Longer ones go into a bucket
for each length, sorted by their bytes.
"""

from __future__ import annotations

import numpy as np

_TERM = np.zeros(256, dtype=bool)
_TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every term; no term goes from one text into the next."""
    inside = _TERM[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[(offsets > 0) & (offsets < len(raw))]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edge - 1] = inside[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def radix_order(*keys: np.ndarray) -> np.ndarray:
    """Stable order by uint64 keys, the first the most significant."""
    order = None
    for key in reversed(keys):
        digits = np.ascontiguousarray(key).view(np.uint16).reshape(-1, 4)  # little-endian: least significant first
        for k in range(4):
            d = digits[:, k] if order is None else digits[order, k]
            if len(d) and (d == d[0]).all():
                continue
            by = np.argsort(d, kind="stable")  # a radix sort for 16-bit integers
            order = by if order is None else order[by]
    return np.arange(len(keys[0])) if order is None else order


def _runs(order: np.ndarray, keys: list[np.ndarray], docs: np.ndarray, weight: np.ndarray | None):
    """Runs of equal (key, doc) in an order: first element of each, its count, and the number of its key."""
    if not len(order):
        return order, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    other = np.ones(len(order), dtype=bool)
    other[1:] = False
    for k in keys:
        s = k[order]
        other[1:] |= s[1:] != s[:-1]
    d = docs[order]
    new = other.copy()
    new[1:] |= d[1:] != d[:-1]
    at = np.flatnonzero(new)
    n = np.diff(np.append(at, len(order))) if weight is None else np.add.reduceat(weight[order], at)
    return order[at], n.astype(np.int64), (np.cumsum(other) - 1)[at]


class Bucket:
    """Terms of one length class: ``keys`` (uint64 columns, or one column of fixed-width bytes), documents and counts."""

    def __init__(self, keys: list[np.ndarray], docs: np.ndarray, counts: np.ndarray | None = None):
        self.keys, self.docs, self.counts = keys, docs, counts

    def reduced(self) -> tuple[Bucket, np.ndarray]:
        """One entry for each (term, document), terms in byte order, and each entry's term number."""
        order = radix_order(*self.keys) if self.keys[0].dtype == np.uint64 else np.argsort(self.keys[0], kind="stable")
        first, n, term = _runs(order, self.keys, self.docs, self.counts)
        return Bucket([k[first] for k in self.keys], self.docs[first], n), term

    def texts(self) -> list[bytes]:
        """Each entry's term; zero bytes pad on the right and are in no term."""
        if self.keys[0].dtype != np.uint64:
            return self.keys[0].tolist()
        wide = np.empty((len(self.docs), len(self.keys)), dtype=">u8")
        for k, key in enumerate(self.keys):
            wide[:, k] = key
        return wide.view(f"S{8 * len(self.keys)}").ravel().tolist()


def buckets(raw: np.ndarray, offsets: np.ndarray) -> dict[int, Bucket]:
    """Terms of texts, by words they fill: 1 and 2, and above these by their length in bytes."""
    raw = _LOWER[raw]
    s, e = spans(raw, offsets)
    size = e - s
    docs = np.searchsorted(offsets, s, side="right") - 1
    out = {}
    wide = np.concatenate([raw, np.zeros(16, dtype=np.uint8)]).astype(np.uint64)
    for shift in (1, 2, 4):
        wide = (wide[:-shift] << np.uint64(8 * shift)) | wide[shift:]
    mask = np.array([0] + [(1 << 64) - (1 << (64 - 8 * k)) for k in range(1, 9)], dtype=np.uint64)
    if (one := size <= 8).any():
        out[1] = Bucket([wide[s[one]] & mask[size[one]]], docs[one])
    if (two := (size > 8) & (size <= 16)).any():
        out[2] = Bucket([wide[s[two]], wide[s[two] + 8] & mask[size[two] - 8]], docs[two])
    for length in np.unique(size[size > 16]).tolist():
        b = size == length
        cells = np.ascontiguousarray(raw[s[b][:, None] + np.arange(length)])
        out[length] = Bucket([cells.view(f"S{length}").ravel()], docs[b])
    return out


def parts(raw: np.ndarray, offsets: np.ndarray, most: int):
    """Cuts texts into runs of about ``most`` bytes, long texts between terms: ``first text, raw, offsets``."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        if j > i:
            yield i, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            i = j
            continue
        a, e = int(offsets[i]), int(offsets[i + 1])
        while a < e:
            b = min(e, a + most)
            while b < e and _TERM[raw[b]]:
                b += 1
            yield i, raw[a:b], np.array([0, b - a])
            a = b
        i += 1


def count(raw: np.ndarray, offsets: np.ndarray, groups: np.ndarray, most: int = 2 << 20):
    """Yields ``terms, group, n, docs`` a bucket: occurrences of each term in each group of texts and texts with it."""
    have: dict[int, list[Bucket]] = {}
    for i, part, off in parts(raw, offsets, most):
        for size, b in buckets(part, off).items():
            small, _ = b.reduced()
            small.docs = small.docs + i
            have.setdefault(size, []).append(small)
    for _, found in sorted(have.items()):
        keys = [np.concatenate(k) for k in zip(*(b.keys for b in found))]
        whole, term = Bucket(keys, np.concatenate([b.docs for b in found]), np.concatenate([b.counts for b in found])).reduced()
        group = groups[whole.docs]
        by = np.lexsort((group, term))
        new = np.ones(len(by), dtype=bool)
        new[1:] = (term[by][1:] != term[by][:-1]) | (group[by][1:] != group[by][:-1])
        at = np.flatnonzero(new)
        pick = by[at]
        terms = Bucket([k[pick] for k in whole.keys], whole.docs[pick]).texts()
        yield terms, group[pick], np.add.reduceat(whole.counts[by], at), np.diff(np.append(at, len(by)))
