"""Elias-Fano sequences over memory-mapped arrays, with vectorised access and search."""

from __future__ import annotations

import itertools

import numpy as np

_U = np.uint64
_SELECT = np.zeros((256, 8), dtype=np.uint8)
for _b in range(256):
    _at = [i for i in range(8) if _b >> i & 1]
    _SELECT[_b, : len(_at)] = _at
#: Every so many ones and zeros of the high bits have their position stored; ones are also summed up per so many words.
STEP = 64
BLOCK = 8


def _pick(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the k-th set bit (from 0) of each 64-bit word."""
    at = np.zeros(len(word), dtype=np.int64)
    for width in (32, 16, 8):
        below = np.bitwise_count(word & _U((1 << width) - 1)).astype(np.int64)
        up = k >= below
        k = k - below * up
        move = up * width
        at += move
        word = word >> move.astype(_U)
    return at + _SELECT[(word & _U(255)).astype(np.int64), k]


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits unary, with sampled positions and sums.

    ``arrays`` gives the parts to store, ``EliasFano(*arrays)`` opens them again;
    the parts may be memory maps.
    """

    @staticmethod
    def arrays(values: np.ndarray) -> list[np.ndarray]:
        v = values.astype(_U)
        n = len(v)
        top = int(v[-1]) + 1 if n else 1
        low = max(0, (top // max(1, n)).bit_length() - 1)
        words = np.zeros(n * low // 64 + 2, dtype=_U)
        if low and n:
            part = v & _U((1 << low) - 1)
            pos = np.arange(n, dtype=_U) * _U(low)
            w, off = (pos >> _U(6)).astype(np.int64), pos & _U(63)
            first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            words[w[first]] = np.bitwise_or.reduceat(part << off, first)
            over = np.flatnonzero(off + _U(low) > _U(64))  # at most one value runs over the end of a word
            words[w[over] + 1] |= part[over] >> (_U(64) - off[over])
        high = (v >> _U(low)).astype(np.int64) + np.arange(n)
        size = (int(high[-1]) + 2 if n else 2) + 64 * BLOCK + 63 >> 9 << 9  # whole blocks, zeros at the end
        bits = np.zeros(size, dtype=np.uint8)
        bits[high] = 1
        zeros = np.flatnonzero(bits == 0)
        kind = np.int32 if size < 1 << 31 else np.int64
        sums = np.searchsorted(high, np.arange(0, size, 64 * BLOCK))
        return [np.array([n, low], dtype=np.int64), words, np.packbits(bits, bitorder="little").view(_U), high[::STEP].astype(kind), zeros[::STEP].astype(kind), sums.astype(kind)]

    def __init__(self, head, words, packed, ones, zeros, sums):
        self.n, self.low = int(head[0]), int(head[1])
        self.words, self.packed, self.ones, self.zeros, self.sums = words, packed, ones, zeros, sums
        self.most = 64 * len(packed) - self.n  # zeros among the high bits: high parts run below that

    def _lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), dtype=_U)
        pos = i.astype(_U) * _U(self.low)
        w, off = (pos >> _U(6)).astype(np.int64), pos & _U(63)
        # a shift by 64 is undefined, so the second word is moved in two steps
        return (self.words[w] >> off | self.words[w + 1] << (_U(63) - off) << _U(1)) & _U((1 << self.low) - 1)

    def _select(self, k: np.ndarray, bit: int) -> np.ndarray:
        """Position of the k-th (from 0) one or zero."""
        flip = _U(0) if bit else ~_U(0)
        pos = (self.ones if bit else self.zeros)[k // STEP].astype(np.int64)
        whole, k = k, k % STEP
        w = pos >> 6
        word = (self.packed[w] ^ flip) & (~_U(0) << (pos & 63).astype(_U))
        act = np.arange(len(k))
        for step in itertools.count():  # on to the word that has it
            have = np.bitwise_count(word[act]).astype(np.int64)
            far = k[act] >= have
            act = act[far]
            if not len(act):
                return w * 64 + _pick(word, k)
            if step == BLOCK:  # a long run of the other kind: the sums tell the block
                upto = self.sums if bit else np.arange(len(self.sums)) * 64 * BLOCK - self.sums
                block = np.searchsorted(upto, whole[act], side="right") - 1
                k[act], w[act] = whole[act] - upto[block], block * BLOCK
            else:
                k[act] -= have[far]
                w[act] += 1
            word[act] = self.packed[w[act]] ^ flip

    def get(self, i: np.ndarray) -> np.ndarray:
        """The i-th values."""
        i = np.asarray(i, dtype=np.int64)
        return (self._select(i, 1) - i).astype(_U) << _U(self.low) | self._lows(i)

    def pair(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The i-th values and the ones after them."""
        at = self._select(i, 1)
        w = at >> 6
        word = self.packed[w] & (~_U(0) << (at & 63).astype(_U) << _U(1))
        act = np.flatnonzero(word == 0)
        for _ in range(BLOCK):
            if not len(act):
                break
            w[act] += 1
            word[act] = self.packed[w[act]]
            act = act[word[act] == 0]
        after = w * 64 + np.bitwise_count((word & (~word + _U(1))) - _U(1))
        if len(act):  # a long run of zeros
            after[act] = self._select(i[act] + 1, 1)
        return tuple((x - j).astype(_U) << _U(self.low) | self._lows(j) for x, j in ((at, i), (after, i + 1)))

    def decode(self, first: int = 0, end: int | None = None) -> np.ndarray:
        """The values from ``first`` to before ``end``; all, if neither is given."""
        end = self.n if end is None else end
        if end <= first:
            return np.zeros(0, dtype=_U)
        a, b = self._select(np.array([first, end - 1]), 1).tolist()
        bits = np.unpackbits(np.asarray(self.packed[a >> 6 : (b >> 6) + 1]).view(np.uint8), bitorder="little")
        high = np.flatnonzero(bits[a & 63 : b - (a >> 6 << 6) + 1]) + a
        i = np.arange(first, end)
        return (high - i).astype(_U) << _U(self.low) | self._lows(i)

    def _search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the first value >= x, end of the values with its high part, low bits of x)."""
        h = np.minimum(x >> _U(self.low), _U(self.most - 1)).astype(np.int64)
        want = x & _U((1 << self.low) - 1)
        start = np.zeros(len(x), dtype=np.int64)
        some = np.flatnonzero(h)
        start[some] = self._select(h[some] - 1, 0) + 1
        # values of this high part: the run of ones that starts here
        w, off = start >> 6, (start & 63).astype(_U)
        gap = ~(self.packed[w] >> off | self.packed[np.minimum(w + 1, len(self.packed) - 1)] << (_U(63) - off) << _U(1))
        run = np.bitwise_count((gap & (~gap + _U(1))) - _U(1)).astype(np.int64)
        long = np.flatnonzero(run >= 63)
        if len(long):
            run[long] = self._select(h[long], 0) - start[long]
        lo = start - h
        end = lo + run
        hi = end.copy()
        act = np.flatnonzero(lo < hi)
        while len(act):
            mid = (lo[act] + hi[act]) >> 1
            less = self._lows(mid) < want[act]
            lo[act[less]] = mid[less] + 1
            hi[act[~less]] = mid[~less]
            act = act[lo[act] < hi[act]]
        return lo, end, want

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value >= x (n if there is none)."""
        out = np.full(len(x), self.n, dtype=np.int64)
        x = x.astype(_U)
        ok = np.flatnonzero(x >> _U(self.low) < _U(self.most))
        out[ok] = np.minimum(self._search(x[ok])[0], self.n)
        return out

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of each x, or -1."""
        out = np.full(len(x), -1, dtype=np.int64)
        x = x.astype(_U)
        ok = np.flatnonzero(x >> _U(self.low) < _U(self.most))
        at, end, want = self._search(x[ok])
        hit = np.flatnonzero(at < end)
        hit = hit[self._lows(at[hit]) == want[hit]]
        out[ok[hit]] = at[hit]
        return out
