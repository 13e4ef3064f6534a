"""N-gram language model in an Elias-Fano trie.

Level 1 holds all words of the training texts by hash.  Levels 2 and 3 hold the
n-grams under their contexts: monotone pointers from a context to its successors,
successor ids as one monotone sequence, 8-bit codes of smoothed probabilities and
of back-off weights.  A trigram's last word is not stored as a word, but as its
place among the successors of the middle word; a query searches level 2 for both
bigrams, then level 3 for that place under the first bigram.

Successors are stored relative to their context: with a pointer a, r successors and
places below s, the successor at place p is a * s + p * r.  That rises over all
contexts, and as words are numbered by hash, each high part has about one value,
whether a context has two successors or a hundred thousand.

A level is cut into parts, each a range of (context, place), so that about PART
occurrences fall into one: the counts of the level above say where.  A context
with more occurrences than that is cut by place.  Keys count from the beginning of
their part, and parts are small enough for them, so that nothing bounds how many
contexts and places a level has.  The texts' n-grams are counted
by part, and the group that counts a part writes its file; a second job over the
files adds the codes.  Workers map the files of the shared folder into memory and
touch what their texts ask for.
"""

from __future__ import annotations

import json
import os
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .eliasfano import EliasFano
from .textkernel import hash_words, utf8_parts
from .workspace import Workspace, text_slices

#: Bigrams and trigrams below these counts are left out, their mass goes to the lower order: every one is kept.
LEAST_COUNT = {2: 1, 3: 1}
#: Subtracted from each kept count (interpolated absolute discounting).
DISCOUNT = 0.75
#: Additive constant of the unigram model, which has one word more for all unseen ones.
ADD = 0.1
#: Occurrences of a part, as long as there are at most PARTS of them; beyond that, parts grow.
PART = 3_000_000
PARTS = 1 << 17
#: What a part's occurrences times its places stay below, so that its keys and successors are whole numbers of 63 bits.
KEYS = 1 << 61
#: Keys that a task holds before it counts them and hands them on.
FLUSH = 4_000_000
#: Files that a worker keeps open, and bytes of those that it had to read whole because they cannot be mapped.
OPEN_FILES = 4096
OPEN_BYTES = 256 << 20
#: Words whose ids a worker remembers (a power of two).
REMEMBERED = 1 << 20
SLICE = 8 << 20

_U = np.uint64


def token_stream(column) -> tuple[np.ndarray, np.ndarray]:
    """63-bit keys of the tokens of all texts (words, then one end each, which has key 0), and text offsets."""
    raw, offsets = utf8_parts(column)
    words, bounds = hash_words(raw, offsets)
    n = len(bounds) - 1
    at = bounds + np.arange(n + 1)
    out = np.zeros(len(words) + n, dtype=_U)
    keep = np.ones(len(out), dtype=bool)
    keep[at[1:] - 1] = False
    out[keep] = np.maximum(words >> _U(1), _U(1))
    return out, at


# counts ------------------------------------------------------------------------------


def _tallied(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys.sort()
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.diff(np.append(at, len(keys)))


def _pack(keys: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted distinct keys with counts: key gaps at a fixed byte width, counts at another."""
    gaps = np.diff(keys, prepend=_U(0))
    w = max(1, -(-int(gaps.max()).bit_length() // 8))
    c = max(1, -(-int(n.max()).bit_length() // 8))
    cols = [gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :w], n.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :c]]
    return bytes([w, c]) + b"".join(np.ascontiguousarray(x.T).tobytes() for x in cols)


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    w, c = blob[0], blob[1]
    m = (len(blob) - 2) // (w + c)
    out = []
    for size, at in ((w, 2), (c, 2 + m * w)):
        raw = np.zeros((m, 8), dtype=np.uint8)
        raw[:, :size] = np.frombuffer(blob, dtype=np.uint8, offset=at, count=m * size).reshape(size, m).T
        out.append(raw.view("<u8")[:, 0])
    return np.cumsum(out[0], dtype=_U), out[1].astype(np.int64)


def _by_part(docs: DataFrame, keys_of, write) -> list[dict]:
    """Counts what ``keys_of(batch)`` gives, parts (int32) and keys in them, for all batches; the one small row that ``write(part, keys, n)`` returns for each part."""

    def gather(batches):
        held, size = [], 0

        def flush():
            part, keys = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            held.clear()
            order = _part_order(part)
            part, keys = part[order], keys[order]
            at = np.append(np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])), len(part))
            for i in range(0, len(at) - 1, 256):
                runs = [slice(a, b) for a, b in zip(at[i : i + 256], at[i + 1 : i + 257])]
                got, blob = [int(part[r.start]) for r in runs], [_pack(*_tallied(keys[r])) for r in runs]
                yield pa.RecordBatch.from_arrays([pa.array(got, pa.int64()), pa.array(blob, pa.binary())], names=["part", "blob"])

        for b in text_slices(batches, SLICE):
            part, keys = keys_of(b)
            if len(keys):
                held.append((part, keys))
            size += len(keys)
            if size >= FLUSH:
                yield from flush()
                size = 0
        if size:
            yield from flush()

    def merge(table):
        part = table.column("part")[0].as_py()
        got = [_unpack(x) for x in table.column("blob").to_pylist()]
        k, n = np.concatenate([x for x, _ in got]), np.concatenate([x for _, x in got])
        order = np.argsort(k, kind="stable")
        k, n = k[order], n[order]
        at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        return pa.table({"info": [json.dumps({"part": part} | write(part, k[at], np.add.reduceat(n, at)))]})

    blobs = docs.mapInArrow(gather, "part long, blob binary")
    rows = blobs.groupBy("part").applyInArrow(merge, "info string").collect()  # one row a part
    return sorted((json.loads(r["info"]) for r in rows), key=lambda x: x["part"])


def _part_order(part: np.ndarray) -> np.ndarray:
    """What sorts part numbers, by their halves of 16 bits, which numpy sorts by radix."""
    order = np.argsort((part & 0xFFFF).astype(np.uint16), kind="stable")
    high = part >> 16
    return order[np.argsort(high[order].astype(np.uint16), kind="stable")] if high.any() else order


def _most(total: int, span: int) -> int:
    """Occurrences that a part should have at most in a level with ``span`` places."""
    return max(1, min(_part_size(total), KEYS // max(1, span) // 2))


def _cut(n: np.ndarray, most: int) -> list[list[int]]:
    """[first context, pieces] of ranges of contexts with about ``most`` occurrences; larger contexts stand alone, in pieces."""
    block = np.cumsum(n) // most
    big = np.flatnonzero(n > most)
    first = np.unique(np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, big, big[big < len(n) - 1] + 1]))
    return [[int(i), int(max(1, -(-int(n[i]) // most)))] for i in first]


class Layout:
    """How the (context, place) of a level are cut into parts; a part is a range of contexts or a range of one context's places.

    ``above`` are the parts of the level of the contexts, with ``offset`` and ``cuts``.
    """

    def __init__(self, above: list[dict], contexts: int, span: int):
        cuts = {(0, 0)}
        for p in above:
            for i, pieces in p["cuts"]:
                cuts.update((p["offset"] + i, j * span // pieces) for j in range(pieces))
        cuts = sorted(cuts)
        lo, hi = np.array(cuts, dtype=np.int64), np.array([*cuts[1:], (contexts, 0)], dtype=np.int64)
        self.c0, self.p0 = lo[:, 0], lo[:, 1]
        self.end_c, self.end_p = hi[:, 0], hi[:, 1]
        piece = self.end_p > 0
        self.c1 = self.end_c + piece
        self.size = np.where(piece, self.end_p, span) - self.p0

    def keys(self, context: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Part of each, and its key there."""
        part = _last_cut(self.c0, self.p0, context, place)
        return part.astype(np.int32), ((context - self.c0[part]) * self.size[part] + place - self.p0[part]).astype(_U)


def _last_cut(c: np.ndarray, p: np.ndarray, context: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Number of the last of the sorted cuts (c, p) that is not behind each (context, place)."""
    at = np.searchsorted(c, context, side="right") - 1
    behind = np.flatnonzero((c[at] == context) & (p[at] > place))
    for last in np.unique(at[behind]).tolist():  # contexts in pieces: only the largest are
        rows = behind[at[behind] == last]
        first = int(np.searchsorted(c, c[last]))
        at[rows] = first - 1 + np.searchsorted(p[first : last + 1], place[rows], side="right")
    return at


def _distinct(context: np.ndarray, place: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (context, place) in order, and which of them each one is."""
    values = None
    if len(context) and (int(context.max()) + 1) * span > KEYS:  # contexts by their rank among those that are here
        values, context = np.unique(context, return_inverse=True)
    uniq, back = np.unique(context * np.int64(span) + place, return_inverse=True)
    c, p = np.divmod(uniq, np.int64(span))
    return c if values is None else values[c], p, back


# files -------------------------------------------------------------------------------


def _put(uri: str, arrays: dict[str, np.ndarray]) -> None:
    """Writes named arrays to one file, each at a multiple of 64 bytes; a repeated task replaces it whole."""
    from pyarrow import fs

    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 64) * 64
    text = json.dumps(head).encode()
    text = text.ljust(-(-(len(text) + 8) // 64) * 64 - 8)
    files, path = fs.FileSystem.from_uri(uri)
    files.create_dir(path.rpartition("/")[0], recursive=True)
    draft = f"{path}.{os.getpid()}-{os.urandom(6).hex()}"
    with files.open_output_stream(draft) as out:
        out.write(len(text).to_bytes(8, "little") + text)
        for a in arrays.values():
            out.write(np.ascontiguousarray(a).tobytes())
            out.write(b"\0" * (-a.nbytes % 64))
    files.move(draft, path)


_opened: OrderedDict[str, tuple[dict, int]] = OrderedDict()


def _get(uri: str) -> dict[str, np.ndarray]:
    """The arrays of a file of the shared folder: mapped, or read where the folder is not mounted.

    A worker keeps the files that it used last, within OPEN_FILES and OPEN_BYTES.
    """
    if uri in _opened:
        _opened.move_to_end(uri)
        return _opened[uri][0]
    if uri.startswith("file:"):
        raw, size = np.memmap("/" + uri.removeprefix("file:").lstrip("/"), dtype=np.uint8, mode="r"), 0
    else:
        from pyarrow import fs

        files, path = fs.FileSystem.from_uri(uri)
        with files.open_input_stream(path) as src:
            raw = np.frombuffer(src.read(), dtype=np.uint8)
        size = len(raw)
    n = int(raw[:8].view("<u8")[0])
    base = 8 + n
    got = {k: np.asarray(raw[base + at : base + at + size_ * np.dtype(kind).itemsize]).view(kind) for k, (kind, size_, at) in json.loads(raw[8:base].tobytes()).items()}
    _opened[uri] = (got, size)
    while len(_opened) > OPEN_FILES or len(_opened) > 1 and sum(s for _, s in _opened.values()) > OPEN_BYTES:
        _opened.popitem(last=False)
    return got


def _ef(prefix: str, values: np.ndarray) -> dict[str, np.ndarray]:
    return {f"{prefix}{i}": a for i, a in enumerate(EliasFano.arrays(values))}


def _open_ef(arrays: dict[str, np.ndarray], prefix: str) -> EliasFano:
    return EliasFano(*(arrays[f"{prefix}{i}"] for i in range(6)))


class Words:
    """Level 1: word keys and counts, in equal ranges of the key."""

    def __init__(self, spec: dict):
        self.folder, self.parts = spec["folder"], spec["parts"]
        self.first = np.array(spec["lo"], dtype=_U)
        self.offset = np.concatenate([[0], np.cumsum(spec["n"])]).astype(np.int64)
        self.held = np.zeros(REMEMBERED, dtype=_U)  # key 0, the end, is looked up each time
        self.held_id, self.held_n = np.zeros(REMEMBERED, dtype=np.int64), np.zeros(REMEMBERED, dtype=np.int64)

    def _file(self, s: int) -> dict:
        return _get(f"{self.folder}/{self.parts[s]:06d}.ef")

    def find(self, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id or -1, count) of each key."""
        if not len(self.parts):
            return np.full(len(stream), -1, dtype=np.int64), np.zeros(len(stream), dtype=np.int64)
        slot = (stream & _U(REMEMBERED - 1)).astype(np.int64)
        ids, n = self.held_id[slot], self.held_n[slot]
        miss = np.flatnonzero((self.held[slot] != stream) | (stream == 0))
        if len(miss):
            key, back = np.unique(stream[miss], return_inverse=True)
            at, c = self._search(key)
            ids[miss], n[miss] = at[back], c[back]
            slot = (key & _U(REMEMBERED - 1)).astype(np.int64)
            self.held[slot], self.held_id[slot], self.held_n[slot] = key, at, c
            # of keys that share a slot, one stands there with what is its own
            wrong = slot[self.held[slot] != key]
            own = np.searchsorted(key, self.held[wrong])
            self.held_id[wrong], self.held_n[wrong] = at[own], c[own]
        return ids, n

    def _search(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, n = np.full(len(key), -1, dtype=np.int64), np.zeros(len(key), dtype=np.int64)
        bounds = np.append(np.searchsorted(key, self.first), len(key))
        for s in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
            a, b, got = bounds[s], bounds[s + 1], self._file(s)
            at = _open_ef(got, "k").find(key[a:b] - self.first[s])
            hit = np.flatnonzero(at >= 0)
            ids[a + hit] = at[hit] + self.offset[s]
            n[a + hit] = got["n"][at[hit]]
        return ids, n

    def count_of(self, ids: np.ndarray) -> np.ndarray:
        out = np.zeros(len(ids), dtype=np.int64)
        part = np.searchsorted(self.offset, ids, side="right") - 1
        for s in np.unique(part).tolist():
            rows = np.flatnonzero(part == s)
            out[rows] = self._file(s)["n"][ids[rows] - self.offset[s]]
        return out


class Level:
    """Level 2 or 3: successors of contexts that are numbered from 0.

    Entries are numbered in the order of their contexts and places.
    """

    def __init__(self, spec: dict):
        self.folder, self.parts, self.span = spec["folder"], spec["parts"], spec["span"]
        # a part has the contexts from c0 to c1 and ``size`` places from p0; between its end and the next part there
        # are no entries, but what begins there is looked up in the next part, which may hold the rest of a context
        self.c0, self.p0, self.size = spec["c0"], spec["p0"], spec["size"]
        self.start = [np.array([0, *spec[k][:-1]], dtype=np.int64) for k in ("end_c", "end_p")]
        self.offset = np.concatenate([[0], np.cumsum(spec["n"])]).astype(np.int64)
        self.prob, self.back = np.array(spec["prob"]), np.array(spec["back"])

    def file(self, s: int, kind: str = "ef") -> dict:
        return _get(f"{self.folder}/{self.parts[s]:06d}.{kind}")

    def _runs(self, at: np.ndarray):
        """(part, slice) of sorted part numbers; rows before the first part are left out."""
        bounds = np.searchsorted(at, np.arange(len(self.parts) + 1))
        for s in np.flatnonzero(bounds[1:] > bounds[:-1]).tolist():
            yield s, slice(bounds[s], bounds[s + 1])

    def _bounds(self, s: int, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pointers to the first successor and past the last, in the part, of sorted contexts."""
        ptr = _open_ef(self.file(s), "p")
        c = context - self.c0[s]
        fresh = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]])) if len(c) else np.zeros(0, dtype=np.int64)
        c = c[fresh]
        a, b = (x.astype(np.int64) for x in ptr.pair(np.clip(c, 0, ptr.n - 2)))
        inside = (c >= 0) & (c < ptr.n - 1)
        times = np.diff(np.append(fresh, len(context)))
        return a.repeat(times), np.where(inside, b, a).repeat(times)

    def _part_of(self, context: np.ndarray, place: np.ndarray | None = None) -> np.ndarray:
        return _last_cut(*self.start, context, np.zeros(len(context), dtype=np.int64) if place is None else place)

    def _part_of_entry(self, entry: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offset, entry, side="right") - 1

    def find(self, context: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the entry of each of the sorted (context, place), or -1; number of its context's first successor."""
        out, first = np.full(len(context), -1, dtype=np.int64), np.zeros(len(context), dtype=np.int64)
        for s, rows in self._runs(self._part_of(context, place)):
            a, b = self._bounds(s, context[rows])
            here = place[rows] - self.p0[s]
            # a context's successors in another part are none of this one's
            some = np.flatnonzero((b > a) & (here >= 0) & (here < self.size[s]))
            at = _open_ef(self.file(s), "k").find(a[some] * self.size[s] + here[some] * (b - a)[some])
            out[rows.start + some] = np.where(at >= 0, at + self.offset[s], -1)
            # a part that begins within a context has its later successors only
            first[rows] = self.first(context[rows]) if self.p0[s] else a + self.offset[s]
        return out, first

    def first(self, context: np.ndarray) -> np.ndarray:
        """Number of the first successor of each of the sorted contexts."""
        out = np.zeros(len(context), dtype=np.int64)
        for s, rows in self._runs(self._part_of(context)):
            ptr = _open_ef(self.file(s), "p")
            out[rows] = ptr.get(np.clip(context[rows] - self.c0[s], 0, ptr.n - 1)).astype(np.int64) + self.offset[s]
        return out

    def backoff(self, context: np.ndarray) -> np.ndarray:
        """Weight of the lower order under each of the sorted contexts; 1 where the context has no successors."""
        out = np.ones(len(context))
        for s, rows in self._runs(self._part_of(context)):
            b = self.file(s, "q")["b"]
            c = context[rows] - self.c0[s]
            inside = (c >= 0) & (c < len(b))
            out[rows] = np.where(inside, self.back[b[np.where(inside, c, 0)]], 1.0)
        return out

    def probability(self, entry: np.ndarray) -> np.ndarray:
        """Of entries in the order of their parts."""
        code = np.zeros(len(entry), dtype=np.uint8)
        for s, rows in self._runs(self._part_of_entry(entry)):
            code[rows] = self.file(s, "q")["q"][entry[rows] - self.offset[s]]
        return self.prob[code]

    def entries(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, count) of sorted entries."""
        place, n = np.zeros(len(entry), dtype=np.int64), np.zeros(len(entry), dtype=np.int64)
        for s, rows in self._runs(self._part_of_entry(entry)):
            i = entry[rows] - self.offset[s]
            i0, i1 = int(i[0]), int(i[-1]) + 1
            ptr, key, upto = (_open_ef(self.file(s, kind), name) for kind, name in (("ef", "p"), ("ef", "k"), ("n", "c")))
            c0, c1 = (ptr.successor(np.array([i0 + 1, i1])) - 1).tolist()
            bounds = ptr.decode(c0, c1 + 2).astype(np.int64)
            c = np.searchsorted(bounds, i, side="right") - 1
            a, b = bounds[c], bounds[c + 1]
            place[rows] = (key.decode(i0, i1).astype(np.int64)[i - i0] - a * self.size[s]) // (b - a) + self.p0[s]
            n[rows] = np.diff(upto.decode(i0, i1 + 1).astype(np.int64))[i - i0]
        return place, n

    def decoded(self, s: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(context, place, count) of all entries of a part."""
        ptr = _open_ef(self.file(s), "p").decode().astype(np.int64)
        size = np.diff(ptr)
        context = np.repeat(np.arange(len(size)), size)
        place = (_open_ef(self.file(s), "k").decode().astype(np.int64) - ptr[context] * self.size[s]) // size[context] + self.p0[s]
        return context + self.c0[s], place, np.diff(_open_ef(self.file(s, "n"), "c").decode().astype(np.int64))


_models: dict[str, Trie] = {}


class Trie:
    """The model as workers see it: levels that exist so far, and totals."""

    def __init__(self, spec: dict):
        self.total, self.distinct = spec["total"], spec["distinct"]
        self.words = Words(spec["words"])
        self.levels = {k: Level(spec[f"level{k}"]) for k in (2, 3) if f"level{k}" in spec}

    @staticmethod
    def open(spec: dict) -> Trie:
        key = f"{spec['path']}:{len(spec)}"
        if key not in _models:
            _models.clear()
            _models[key] = Trie(spec)
        return _models[key]

    def unigram(self, n: np.ndarray) -> np.ndarray:
        return (n + ADD) / (self.total + ADD * (self.distinct + 1))

    def bigrams(self, stream: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and counts of all tokens; where in the stream a known word follows one of the same text."""
        ids, n = self.words.find(stream)
        inner = np.ones(len(stream), dtype=bool)
        inner[at[:-1]] = False
        ok = np.flatnonzero(inner[1:] & (ids[1:] >= 0) & (ids[:-1] >= 0)) + 1
        return ids, n, ok

    def lookup(self, stream: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
        """Ids and counts of tokens; entries of the bigrams and trigrams that end at each (-1: none).

        ``found``: per order, the places looked up, the distinct entries in order, and which of them each place has.
        """
        ids, n, ok = self.bigrams(stream, at)
        out = {"ids": ids, "n": n, "two": np.full(len(stream), -1, dtype=np.int64), "found": {}}
        if 2 in self.levels:
            two = out["two"]
            *pairs, back = _distinct(ids[ok - 1], ids[ok], self.distinct)
            got, first = self.levels[2].find(*pairs)
            two[ok] = got[back]
            out["found"][2] = ok, got, back
            # a trigram needs both bigrams; its place is that of the second among the middle word's
            both = np.flatnonzero((two[1:] >= 0) & (two[:-1] >= 0)) + 1
            begins = np.zeros(len(stream), dtype=np.int64)
            begins[ok] = first[back]
            place = two[both] - begins[both]
            out["both"], out["pairs"] = both, (two[both - 1], place)
        if 3 in self.levels:
            out["three"] = np.full(len(stream), -1, dtype=np.int64)
            *pairs, back = _distinct(*out["pairs"], self.levels[3].span)
            got, _ = self.levels[3].find(*pairs)
            out["three"][out["both"]] = got[back]
            out["found"][3] = out["both"], got, back
        return out

    def score(self, stream: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
        """Per text: tokens, known tokens, base score and model score (log10)."""
        got = self.lookup(stream, at)
        p1 = self.unigram(got["n"])
        p = p1.copy()
        start = np.zeros(len(stream), dtype=bool)
        start[at[:-1]] = True
        inner = np.flatnonzero(~start)
        for k, name in ((2, "two"), (3, "three")):
            if k not in self.levels:
                continue
            level, entry = self.levels[k], got[name]
            # only what has no entry of this order is weighed down
            lack = inner[entry[inner] < 0]
            context = got["ids"][lack - 1] if k == 2 else got["two"][lack - 1]
            some = np.flatnonzero(context >= 0)
            uniq, back = np.unique(context[some], return_inverse=True)
            p[lack[some]] *= level.backoff(uniq)[back]
            at_, found, back = got["found"][k]
            prob = np.zeros(len(found))
            prob[found >= 0] = level.probability(found[found >= 0])
            hit = np.flatnonzero(entry[at_] >= 0)
            p[at_[hit]] = prob[back[hit]]
        sums = [np.add.reduceat(np.concatenate([x, [0.0]]), at[:-1]) if len(at) > 1 else np.zeros(0) for x in (np.log10(p1), np.log10(p), (got["n"] > 0).astype(float))]
        return {"n_tokens": np.diff(at), "n_known": sums[2].astype(np.int64), "base": sums[0], "model": sums[1]}


# building ----------------------------------------------------------------------------


def _steps(least: float) -> list[float]:
    """256 values in even steps of the logarithm from ``least`` to 1: codes are off by half a step at most."""
    return np.geomspace(min(least, 0.5), 1.0, 256).tolist()


def _code(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    low = np.log(book[0])
    return np.clip(np.rint((np.log(x) - low) / -low * 255), 0, 255).astype(np.uint8)


def _kept(context: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct contexts, where each begins, and its counts less the discounts."""
    first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
    return context[first], first, np.add.reduceat(n - DISCOUNT, first)


def _add_level(spec: dict, order: int, texts: DataFrame, pairs_of, contexts: int, span: int, above: list[dict], most: int, least: int, ws: Workspace) -> list[dict]:
    """Adds a level of ``contexts`` contexts to ``spec``; returns its parts.

    ``pairs_of(batch)`` gives contexts and places, ``above`` are the parts of the
    level of the contexts, ``most`` the largest count there.
    """
    folder, cut = ws.folder(f"trie-{order}"), Layout(above, contexts, span)

    def keys_of(b):
        return cut.keys(*pairs_of(b))

    def write(part, key, n):
        keep = n >= least
        key, n = key[keep].astype(np.int64), n[keep]
        if not len(key):
            return {"n": 0}
        lo, hi, size = cut.c0[part], cut.c1[part], cut.size[part]
        context, place = np.divmod(key, size)
        context += lo
        uniq, first, kept = _kept(context, n)
        types = np.diff(np.append(first, len(key)))
        uri = f"{folder}/{part:06d}"
        _put(f"{uri}.ef", _ef("k", np.repeat(first * size, types) + place * np.repeat(types, types)) | _ef("p", np.searchsorted(context, np.arange(lo, hi + 1))))
        _put(f"{uri}.n", _ef("c", np.concatenate([[0], np.cumsum(n)])))
        # contexts at either end may go on in other parts
        ends = {int(uniq[i]): [float(kept[i]), int(types[i])] for i in (0, len(uniq) - 1)}
        return {"n": len(key), "most": int(n.max()), "types": int(types.max()), "ends": list(ends.items())}

    found = [p for p in _by_part(texts, keys_of, write) if p["n"]]
    offset, across = 0, {}
    for p in found:
        p["offset"] = offset
        offset += p["n"]
        for c, (kept, types) in p["ends"]:
            have = across.get(c, (0.0, 0))
            across[c] = (have[0] + kept, have[1] + types)
    if not found:
        return []
    before = dict(spec)
    level = {"folder": folder, "span": span, "parts": [p["part"] for p in found], "n": [p["n"] for p in found]}
    level |= {k: getattr(cut, k)[level["parts"]].tolist() for k in ("c0", "c1", "p0", "size", "end_c", "end_p")}
    level["prob"], level["back"] = _steps((least - DISCOUNT) / most), _steps(min(least - DISCOUNT, DISCOUNT) / most)
    most_types = max([*(p["types"] for p in found), *(t for _, t in across.values())])
    next_most = _most(spec["total"], most_types)
    rows = [(i, [c for c, _ in p["ends"]], [across[c][0] for c, _ in p["ends"]]) for i, p in enumerate(found)]

    def finish(batches):
        trie, here = Trie.open(before), Level(level)
        for b in batches:
            for r in b.to_pylist():
                s = r["part"]
                context, place, n = here.decoded(s)
                uniq, first, kept = _kept(context, n)
                for c, whole in zip(r["ends"], r["kept"]):
                    kept[np.searchsorted(uniq, c)] = whole
                run = np.diff(np.append(first, len(n)))
                if order == 2:
                    total = trie.words.count_of(uniq)
                    lower = trie.unigram(trie.words.count_of(place))
                else:
                    word, total = trie.levels[2].entries(uniq)
                    mid, back = np.unique(word, return_inverse=True)
                    entry = trie.levels[2].first(mid)[back].repeat(run) + place
                    order_ = _part_order(trie.levels[2]._part_of_entry(entry))
                    lower = np.empty(len(entry))
                    lower[order_] = trie.levels[2].probability(entry[order_])
                weight = np.clip((total - kept) / total, here.back[0], 1.0)
                p = (n - DISCOUNT) / total.repeat(run) + weight.repeat(run) * lower
                lo = level["c0"][s]
                codes = np.full(level["c1"][s] - lo, 255, dtype=np.uint8)  # contexts without successors weigh 1
                codes[uniq - lo] = _code(weight, here.back)
                _put(f"{folder}/{here.parts[s]:06d}.q", {"q": _code(np.minimum(p, 1.0), here.prob), "b": codes})
                yield _cuts_row(s, n if order == 2 else None, next_most)

    # one row a part: the list is as long as the level has files
    made = ws.spark.createDataFrame(rows, "part long, ends array<long>, kept array<double>")
    cuts = dict(made.repartitionByRange(min(len(rows), 4096), "part").mapInArrow(finish, CUTS).collect())
    spec[f"level{order}"] = level
    return [p | {"most_types": most_types, "cuts": json.loads(cuts[i])} for i, p in enumerate(found)]


CUTS = "part long, cuts string"


def _cuts_row(part: int, n: np.ndarray | None, most: int) -> pa.RecordBatch:
    """Where the next level is cut below the entries of a part, which have the counts ``n``."""
    return pa.RecordBatch.from_pylist([{"part": part, "cuts": json.dumps([] if n is None else _cut(n, most))}], schema=pa.schema([("part", pa.int64()), ("cuts", pa.string())]))


def _word_cuts(spec: dict, ws: Workspace) -> dict[int, list]:
    """``_cut`` of every part of level 1."""
    most, folder = _most(spec["total"], spec["distinct"]), spec["words"]["folder"]

    def run(batches):
        for b in batches:
            for part in b.column(0).to_pylist():
                yield _cuts_row(part, _get(f"{folder}/{part:06d}.ef")["n"].astype(np.int64), most)

    parts = spec["words"]["parts"]
    made = ws.spark.createDataFrame([(p,) for p in parts], "part long").repartitionByRange(min(len(parts), 4096), "part")
    return {p: json.loads(text) for p, text in made.mapInArrow(run, CUTS).collect()}  # one row a part


def _part_size(total: int) -> int:
    return max(PART, -(-total // PARTS))


def train(docs: DataFrame, ws: Workspace, order: int = 3, least: dict[int, int] = LEAST_COUNT) -> dict:
    """Builds the trie of ``docs(doc_id, text)`` and returns its description: folders, parts and totals.

    N-grams of order k below the count ``least[k]`` are left out.
    """
    texts = docs.select("doc_id", "text")
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    most = _part_size(size // 4)
    bits = max(2, min(17, int(size // 4 // most).bit_length()))
    folder = ws.folder("trie-1")

    def write_words(part, key, n):
        _put(f"{folder}/{part:06d}.ef", _ef("k", key) | {"n": n.astype(np.uint32) if n.max() < 1 << 32 else n})
        return {"n": len(key), "total": int(n.sum()), "most": int(n.max())}

    def word_keys(b):
        key = token_stream(b.column(1))[0]
        part = key >> _U(63 - bits)
        return part.astype(np.int32), key - (part << _U(63 - bits))

    parts = _by_part(texts, word_keys, write_words)
    total, distinct = sum(p["total"] for p in parts), sum(p["n"] for p in parts)
    before = 0
    for p in parts:
        p["offset"], before = before, before + p["n"]
    spec: dict = {"path": ws.path, "total": total, "distinct": distinct}
    spec["words"] = {"folder": folder, "parts": [p["part"] for p in parts], "n": [p["n"] for p in parts], "lo": [p["part"] << (63 - bits) for p in parts]}
    if not total or order < 2:
        return spec

    base, cuts = dict(spec), _word_cuts(spec, ws)
    parts = [p | {"cuts": cuts[p["part"]]} for p in parts]

    def bigrams(b):
        ids, _, ok = Trie.open(base).bigrams(*token_stream(b.column(1)))
        return ids[ok - 1], ids[ok]

    two = _add_level(spec, 2, texts, bigrams, distinct, distinct, parts, max(p["most"] for p in parts), least[2], ws)
    if not two or order < 3:
        return spec

    upto2, span = dict(spec), two[0]["most_types"]  # places are below the number of successors

    def trigrams(b):
        return Trie.open(upto2).lookup(*token_stream(b.column(1)))["pairs"]

    n2 = two[-1]["offset"] + two[-1]["n"]
    _add_level(spec, 3, texts, trigrams, n2, span, two, max(p["most"] for p in two), least[3], ws)
    return spec


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, spec: dict) -> DataFrame:
    """Scores every row of ``docs(doc_id, text, held_out)``; columns as in ``SCORES``.

    A null text counts as empty: its one token is the end.  Repeated rows repeat,
    an empty table gives no rows.  Without training texts every word has the
    uniform share of the unseen.
    """

    def run(batches):
        trie = Trie.open(spec)
        for b in text_slices(batches, SLICE):
            stream, at = token_stream(b.column(1))
            s = trie.score(stream, at)
            n = len(at) - 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(s["n_tokens"]), pa.array(s["n_known"]), pa.array(np.full(n, trie.total, dtype=np.int64)), pa.array(s["base"]), pa.array(s["model"])],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, SCORES)


def train_and_score(docs: DataFrame, folds: int = 10, order: int = 3, least: dict[int, int] = LEAST_COUNT) -> DataFrame:
    """Trains on the rows outside fold 0 of crc32(doc_id) and scores all rows.

    A null doc_id is never held out.  ``least`` is as for ``train``.
    """
    ws = Workspace(docs.sparkSession, "ngramlm")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    rows = docs.select("doc_id", "text", held.alias("held_out"))
    spec = train(rows.where(~F.col("held_out")), ws, order, least)
    return score(rows, spec)
