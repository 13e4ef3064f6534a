"""Partition transforms counted from the epoch, and the bucket hash."""

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def year(c: Column) -> Column:
    return (F.year(c) - 1970).cast("long")


def month(c: Column) -> Column:
    return ((F.year(c) - 1970) * 12 + F.month(c) - 1).cast("long")


def day(c: Column) -> Column:
    return F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")


def hour(c: Column) -> Column:
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(3_600_000_000)).cast("long")


def _u32(c: Column) -> Column:
    return c.bitwiseAND(F.lit(0xFFFFFFFF))


def _mul(c: Column, k: int) -> Column:
    """32-bit product in 64-bit arithmetic: halves keep every step below 2**63."""
    lo, hi = c.bitwiseAND(F.lit(0xFFFF)), F.shiftrightunsigned(c, 16)
    return _u32(lo * F.lit(k) + F.shiftleft(_u32(hi * F.lit(k)), 16))


def _rotl(c: Column, r: int) -> Column:
    return _u32(F.shiftleft(c, r)).bitwiseOR(F.shiftrightunsigned(c, 32 - r))


def _round(h: Column, k: Column) -> Column:
    k = _mul(_rotl(_mul(k, 0xCC9E2D51), 15), 0x1B873593)
    return _u32(_rotl(h.bitwiseXOR(k), 13) * F.lit(5) + F.lit(0xE6546B64))


def _finish(h: Column, size: int) -> Column:
    h = h.bitwiseXOR(F.lit(size).cast("long"))
    h = _mul(h.bitwiseXOR(F.shiftrightunsigned(h, 16)), 0x85EBCA6B)
    h = _mul(h.bitwiseXOR(F.shiftrightunsigned(h, 13)), 0xC2B2AE35)
    return h.bitwiseXOR(F.shiftrightunsigned(h, 16))


def murmur3_long(c: Column) -> Column:
    """Murmur3 x86 32 with seed 0 over the 8 little-endian bytes of a long, as 0..2**32-1."""
    c = c.cast("long")
    h = _round(F.lit(0).cast("long"), _u32(c))
    return _finish(_round(h, _u32(F.shiftrightunsigned(c, 32))), 8)


def bucket(c: Column, n: int) -> Column:
    """Bucket of an integer: hash masked to be positive, modulo n."""
    return (murmur3_long(c).bitwiseAND(F.lit(0x7FFFFFFF)) % F.lit(n)).cast("long")


def bucket_text(c: Column, n: int) -> Column:
    """Bucket of a text by its UTF-8 bytes; null for null.  An Arrow batch is hashed as one array."""

    @F.pandas_udf("long")
    def run(s: pd.Series) -> pd.Series:
        out, here = pd.Series(pd.NA, index=s.index, dtype="Int64"), s.notna()
        out[here] = (murmur3_texts([x.encode() for x in s[here]]) & np.uint32(0x7FFFFFFF)).astype(np.int64) % n
        return out

    return run(c)


def murmur3_texts(data: list[bytes]) -> np.ndarray:
    """Murmur3 x86 32 with seed 0 of each of the byte strings."""
    u = np.uint32
    size = np.array([len(x) for x in data], dtype=np.int64)
    k = np.frombuffer(b"".join(x + bytes(-len(x) % 4) for x in data), dtype="<u4") * u(0xCC9E2D51)
    k = (k << u(15) | k >> u(17)) * u(0x1B873593)
    whole, words = size // 4, (size + 3) // 4
    start = np.cumsum(words) - words
    h, at, act = np.zeros(len(data), dtype=u), 0, np.flatnonzero(whole)
    while len(act) > 8:  # the next word of every text that has one
        x = h[act] ^ k[start[act] + at]
        h[act] = (x << u(13) | x >> u(19)) * u(5) + u(0xE6546B64)
        at += 1
        act = act[whole[act] > at]
    for i in act.tolist():  # the few longest, one after the other
        x = int(h[i])
        for word in k[start[i] + at : start[i] + whole[i]].tolist():
            x ^= word
            x = ((x << 13 | x >> 19) & 0xFFFFFFFF) * 5 + 0xE6546B64 & 0xFFFFFFFF
        h[i] = x
    rest = np.flatnonzero(words > whole)
    h[rest] ^= k[start[rest] + whole[rest]]
    h ^= size.astype(u)
    h = (h ^ h >> u(16)) * u(0x85EBCA6B)
    h = (h ^ h >> u(13)) * u(0xC2B2AE35)
    return h ^ h >> u(16)
