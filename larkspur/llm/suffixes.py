"""Suffix arrays by two-stage sorting, and segments that hold every window of a text.

A block of byte strings becomes one string of symbols, byte + 1, with 0 behind each
string.  Suffixes smaller than their successors are sorted directly, by as many
symbols as a window has; all others follow by scans of the buckets of equal first
symbols; adjacent common prefixes then tell which windows are equal.
"""

from __future__ import annotations

import numpy as np

from .textkernel import _BASE, _BASE_INV, _table, mix

_rng = np.random.Generator(np.random.PCG64(0xB17E5))
_BYTE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Symbols of 9 bits in a word.
PACK = 7


def block(strings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all strings, and where each begins."""
    sizes = np.array([len(s) + 1 for s in strings], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), dtype=np.uint16)
    inside = np.ones(len(out), dtype=bool)
    inside[starts + sizes - 1] = False
    out[inside] = np.concatenate(strings).astype(np.uint16) + 1 if strings else 0
    return out, starts


def rising(symbols: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors; ends of strings are not."""
    n = len(symbols)
    step = np.zeros(n, dtype=np.int32)
    step[:-1] = symbols[1:].astype(np.int32) - symbols[:-1]
    step[-1] = -1
    at = np.where(step != 0, np.arange(n), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]  # equal neighbours have the order of the next unequal pair
    return (step[at] > 0) & (symbols > 0)


def words(symbols: np.ndarray) -> np.ndarray:
    """PACK symbols from each position as one number that compares as they do."""
    out = np.zeros(len(symbols), dtype=np.uint64)
    wide = np.concatenate([symbols, np.zeros(PACK, dtype=np.uint16)]).astype(np.uint64)
    for k in range(PACK):
        out = (out << np.uint64(9)) | wide[k : k + len(symbols)]
    return out


def _ranks(values: np.ndarray) -> np.ndarray:
    """Dense ranks from 0."""
    order = np.argsort(values)
    up = np.zeros(len(values), dtype=np.uint64)
    s = values[order]
    up[1:] = np.cumsum(s[1:] != s[:-1])
    out = np.empty(len(values), dtype=np.uint64)
    out[order] = up
    return out


def direct_sort(chosen: np.ndarray, packed: np.ndarray, depth: int) -> np.ndarray:
    """``chosen`` suffixes in the order of their first ``depth`` symbols."""
    order, rank = chosen.copy(), _ranks(packed)
    todo, group = np.arange(len(order)), np.zeros(len(order), dtype=np.uint64)
    last = np.uint64(len(packed))
    for skip in range(0, depth, PACK):
        if not len(todo):
            break
        suffix = order[todo]
        at = suffix + skip
        # a suffix that ends before compares as an end, smaller than all
        value = np.where(at < len(packed), rank[np.minimum(at, len(packed) - 1)] + np.uint64(1), np.uint64(0))
        key = group * (last + np.uint64(2)) + value
        by = np.argsort(key)
        order[todo] = suffix[by]
        key = key[by]
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        tied = ~new
        tied[:-1] |= ~new[1:]
        group, todo = np.cumsum(new).astype(np.uint64)[tied], todo[tied]
    return order


def suffix_array(symbols: np.ndarray, packed: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes, ordered by at least their first ``depth`` symbols."""
    n = len(symbols)
    up = rising(symbols)
    ordered = direct_sort(np.flatnonzero(up), packed, depth)
    count = np.bincount(symbols, minlength=257)
    ups = np.bincount(symbols[ordered], minlength=257)
    start = np.cumsum(count) - count
    out = np.full(n, -1, dtype=np.int64)
    head = start.copy()
    # rising suffixes fill their buckets' ends, ends of strings the first bucket
    edge = np.cumsum(ups) - ups
    for c in np.flatnonzero(ups):
        out[start[c] + count[c] - ups[c] : start[c] + count[c]] = ordered[edge[c] : edge[c] + ups[c]]
    out[: count[0]] = np.flatnonzero(symbols == 0)

    def induce(found: np.ndarray) -> None:
        """The falling predecessors of ``found`` take the next places of their buckets."""
        before = found[found > 0] - 1
        before = before[~up[before] & (symbols[before] > 0)]
        if not len(before):
            return
        sym = symbols[before]
        by = np.argsort(sym, kind="stable")
        before, sym = before[by], sym[by]
        cut = np.flatnonzero(np.concatenate([[True], sym[1:] != sym[:-1]]))
        for a, b in zip(cut, [*cut[1:], len(sym)]):
            c = sym[a]
            out[head[c] : head[c] + b - a] = before[a:b]
            head[c] += b - a

    for c in np.flatnonzero(count):
        done = start[c]
        if c == 0:
            induce(out[: count[0]])
            continue
        while done < head[c]:  # a run of one symbol is induced from its own bucket
            upto = head[c]
            induce(out[done:upto])
            done = upto
        if ups[c]:
            induce(out[start[c] + count[c] - ups[c] : start[c] + count[c]])
    return out


def equal_to_previous(order: np.ndarray, packed: np.ndarray, symbols: np.ndarray, window: int) -> np.ndarray:
    """Whether each suffix has ``window`` symbols in common with the one before it."""
    out = np.zeros(len(order), dtype=bool)
    left = np.arange(1, len(order))
    for skip in range(0, window - PACK + 1, PACK):
        left = left[packed[order[left] + skip] == packed[order[left - 1] + skip]]
    for skip in range(window - window % PACK, window):
        left = left[symbols[order[left] + skip] == symbols[order[left - 1] + skip]]
    out[left] = True
    return out


def equal_windows(strings: list[np.ndarray], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of equal windows of the strings: ``class, string, offset`` of all windows, classes together."""
    symbols, starts = block(strings)
    packed = words(symbols)
    order = suffix_array(symbols, packed, window)
    which = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(symbols))))
    ends = np.append(starts[1:], len(symbols)) - 1
    order = order[order + window <= ends[which[order]]]
    classes = np.cumsum(~equal_to_previous(order, packed, symbols, window))
    return classes, which[order], order - starts[which[order]]


# segments ------------------------------------------------------------------------------


def lots(offsets: np.ndarray, most: int, window: int):
    """Byte ranges (a, b) of about ``most`` bytes: whole texts, or parts of one that share window - 1 bytes."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        if j > i:
            yield int(offsets[i]), int(offsets[j])
            i = j
            continue
        a, e = int(offsets[i]), int(offsets[i + 1])
        while True:
            b = min(e, a + most)
            yield a, b
            if b == e:
                break
            a = b - window + 1
        i += 1


def _least(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours."""
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (w - size)], x[w - size :]) if size < w else x


def segments(raw: np.ndarray, offsets: np.ndarray, window: int, gram: int, longest: int, most: int = 1 << 20):
    """Runs of neighbouring windows that have the same least gram hash.

    Returns ``text, at, n, inner, gram_hash, digest``: windows ``at .. at + n - 1`` of
    a text, whether the gram occurs in them more than once (only then can two of them
    be equal), its hash, and a hash of all their bytes.  Equal windows have equal gram
    hashes wherever they are; every window is in one run.
    """
    w = window - gram + 1
    out: list[list[np.ndarray]] = [[] for _ in range(6)]
    for a, b in lots(offsets, most, window):
        n = b - a
        if n < window:
            continue
        part = raw[a:b]
        power, inverse = _table("p", _BASE, n), _table("i", _BASE_INV, n + 1)
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[part] * power[:n], out=total[1:])
        grams = mix((total[gram:] - total[:-gram]) * inverse[: n - gram + 1])
        least = _least(grams, w)
        first = np.ones(len(least), dtype=bool)
        first[1:] = least[1:] != least[:-1]
        # a text's windows end before its end, and no run goes from one text into the next
        lo, hi = np.searchsorted(offsets, a, side="right") - 1, np.searchsorted(offsets, b, side="left")
        begin = np.maximum(offsets[lo:hi], a) - a
        end = np.minimum(offsets[lo + 1 : hi + 1], b) - a
        begin, end = begin[end - begin > 0], end[end - begin > 0]
        first[begin[begin < len(least)]] = True
        stop = np.maximum(end - window + 1, begin)  # the first start that is no window
        first[stop[stop < len(least)]] = True
        good = np.zeros(len(least) + 1, dtype=np.int32)
        has = stop > begin
        np.add.at(good, begin[has], 1)
        np.add.at(good, stop[has], -1)
        at = np.flatnonzero(first)
        n_win = np.diff(np.append(at, len(least)))
        keep = np.cumsum(good)[at] > 0
        at, n_win = at[keep], n_win[keep]
        if len(n_win) and n_win.max() > longest:  # long runs are cut, which only makes more of them
            times = -(-n_win // longest)
            step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            at, n_win = np.repeat(at, times) + step * longest, np.minimum(longest, np.repeat(n_win, times) - step * longest)
        if not len(at):
            continue
        value = least[at]
        held = np.zeros(len(at), dtype=np.int64)
        for k in range(w):
            held += grams[at + k] == value
        last = np.zeros(len(least) + 1, dtype=np.int64)  # windows whose last gram is their least
        np.cumsum(grams[w - 1 :] == least, out=last[1:])
        held += last[at + n_win] - last[at + 1]
        e = at + n_win + window - 1
        digest = mix((total[e] - total[at]) * inverse[at] + n_win.astype(np.uint64) * np.uint64(_BASE & 0xFFFFFFFFFFFFFFFF))
        text = np.searchsorted(offsets, at + a, side="right") - 1
        for k, x in enumerate((text, at + a - offsets[text], n_win, held > 1, value, digest)):
            out[k].append(x)
    kinds = (np.int64, np.int64, np.int64, bool, np.uint64, np.uint64)
    return [np.concatenate(x).astype(t) if x else np.zeros(0, dtype=t) for x, t in zip(out, kinds)]
