"""Removal of repeated passages: bytes that a window covers which also starts earlier.

Texts are cut into segments, runs of windows with the same least gram hash, so equal
windows are in segments of one hash.  Of segments with equal bytes only the earliest
goes on, the windows of all others are removed.  Where a hash has different segments
(or one that may repeat within itself), their bytes are dealt by the hash, and suffix
arrays over blocks of whole hashes find equal windows; all but the earliest of a class
are removed.  A hash with more than ``CROWD`` different segments is dealt on by the
content of its windows, so that no block grows with it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .suffixes import equal_windows, segments
from .textkernel import mix, utf8_parts
from .workspace import Workspace, text_slices

WINDOW = 100
#: Bytes that a gram has; a window is found by the least of its 69 grams.
GRAM = 32
#: Most windows of a segment.
LONGEST = 1024
#: Different segments of one hash beyond which its windows are dealt by content.
CROWD = 20_000
#: Bytes of text that are cut, and of segments that are sorted, at a time.
SLICE, BLOCK = 16 << 20, 1 << 20

_CUT = pa.schema([("h", pa.int64()), ("g", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("at", pa.int64()), ("n", pa.int32())])
_FOUND = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("at", pa.int64()), ("n", pa.int32())])
_SEEN = pa.schema([*_FOUND, ("part", pa.int32()), ("bytes", pa.binary())])
_GONE = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("at", pa.int64()), ("n", pa.int32())])


def _ddl(schema: pa.Schema) -> str:
    names = {"int64": "long", "int32": "int"}
    return ", ".join(f"{f.name} {names.get(str(f.type), str(f.type))}" for f in schema)


def _batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    cast = [c if isinstance(c, pa.Array) else pa.array(c.view(np.int64) if c.dtype == np.uint64 else c) for c in columns]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cast, schema)], schema=schema)


def _order_of(ids: pa.Array, ties: np.ndarray) -> np.ndarray:
    """Dense rank of each document: by id, null behind all, then by tie."""
    null = ids.is_null().to_numpy(zero_copy_only=False)
    num = ids.fill_null(0).to_numpy(zero_copy_only=False)
    by = np.lexsort((ties, num, null))
    new = np.zeros(len(by), dtype=np.int64)
    new[1:] = (ties[by][1:] != ties[by][:-1]) | (num[by][1:] != num[by][:-1]) | (null[by][1:] != null[by][:-1])
    out = np.empty(len(by), dtype=np.int64)
    out[by] = np.cumsum(new)
    return out


def _merged(doc: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of one document that follow each other, as one run each (within 31 bits)."""
    by = np.lexsort((at, doc))
    doc, at, n = doc[by], at[by], n[by].astype(np.int64)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + n[:-1]) | (at[1:] >> 30 != at[:-1] >> 30)
    k = np.flatnonzero(new)
    end = np.maximum.reduceat(at + n, k) if len(k) else at[:0]
    return doc[k], at[k], end - at[k]


def cut(rows: DataFrame) -> DataFrame:
    """Segments of ``rows(doc_id, tie, text)``: the earliest of each slice with equal bytes, and without ``g`` what is removed."""

    def run(batches):
        for b in text_slices(batches, SLICE):
            ids, ties = b.column(0), b.column(1).to_numpy(zero_copy_only=False)
            raw, offsets = utf8_parts(b.column(2))
            doc, at, n, inner, h, g = segments(raw, offsets, WINDOW, GRAM, LONGEST)
            if not len(doc):
                continue
            rank = _order_of(ids, ties)
            by = np.lexsort((at, rank[doc], g, h))
            doc, at, n, h, g = doc[by], at[by], np.where(inner, -n, n)[by], h[by], g[by]
            first = np.ones(len(doc), dtype=bool)
            first[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
            head = np.maximum.accumulate(np.where(first, np.arange(len(doc)), 0))
            yield _batch(_CUT, h[first], g[first], ids.take(pa.array(doc[first])), ties[doc[first]], at[first], n[first])
            gone = ~first & ((rank[doc] != rank[doc][head]) | (at != at[head]))
            if gone.any():
                d, a, m = _merged(doc[gone], at[gone], np.abs(n[gone]))
                none = pa.nulls(len(d), pa.int64())
                yield _batch(_CUT, mix(ties[d].view(np.uint64) + a.astype(np.uint64)), none, ids.take(pa.array(d)), ties[d], a, m)

    return rows.select("doc_id", "tie", "text").mapInArrow(run, _ddl(_CUT))


def compare(segments_: DataFrame) -> DataFrame:
    """Removed windows, without ``h``, and the segments whose bytes must be sorted, with it.

    A hash's rows pass in order, so that what is kept between batches is one segment.
    """
    dealt = segments_.repartition("h").sortWithinPartitions("h", "g", F.asc_nulls_last("doc_id"), "tie", "at")

    def run(batches):
        held: pa.RecordBatch | None = None  # the first segment of the last hash, and
        sent, top = False, None  # whether it went on; the earliest place of the last segment
        for b in batches:
            if not b.num_rows:
                continue
            none = b.column(1).is_null().to_numpy(zero_copy_only=False)
            if none.any():
                x = b.filter(pa.array(none))
                yield _batch(_FOUND, pa.nulls(x.num_rows, pa.int64()), *(x.column(k) for k in (2, 3, 4, 5)))
                b = b.filter(pa.array(~none))
                if not b.num_rows:
                    continue
            if top is not None:
                b = pa.Table.from_batches([top, b]).combine_chunks().to_batches()[0]
            h, g, tie, at = (b.column(k).to_numpy() for k in (0, 1, 3, 4))
            n = np.abs(b.column(5).to_numpy().astype(np.int64)).astype(np.int32)
            num, null = b.column(2).fill_null(0).to_numpy(), b.column(2).is_null().to_numpy(zero_copy_only=False)
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (g[1:] != g[:-1])
            head = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
            gone = ~new & ((num != num[head]) | (null != null[head]) | (tie != tie[head]) | (at != at[head]))
            if gone.any():
                x = b.filter(pa.array(gone))
                yield _batch(_FOUND, pa.nulls(x.num_rows, pa.int64()), x.column(2), x.column(3), x.column(4), n[gone])
            if top is not None:
                new[0] = False  # it was one of the batch before
            top = b.slice(int(head[-1]), 1)
            fresh = b.filter(pa.array(new))
            if held is not None:
                fresh = pa.Table.from_batches([held, fresh]).combine_chunks().to_batches()[0]
            if not fresh.num_rows:
                continue
            fh = fresh.column(0).to_numpy()
            start = np.ones(len(fh), dtype=bool)
            start[1:] = fh[1:] != fh[:-1]
            run_of = np.cumsum(start) - 1
            inner = fresh.column(5).to_numpy() < 0
            go = (np.bincount(run_of)[run_of] > 1) | inner
            last = int(np.flatnonzero(start)[-1])
            if held is not None and sent:
                done = go[0]
                go[0] = False
            else:
                done = False
            if go.any():
                x = fresh.filter(pa.array(go))
                yield _batch(_FOUND, x.column(0), x.column(2), x.column(3), x.column(4), np.abs(x.column(5).to_numpy()))
            held, sent = fresh.slice(last, 1), bool(go[last]) or (last == 0 and bool(done)) or (last == 0 and sent)

    return dealt.mapInArrow(run, _ddl(_FOUND))


def fetch(asked: DataFrame, texts: DataFrame) -> DataFrame:
    """The bytes of segments ``asked(h, doc_id, tie, at, n, crowd)``; crowded hashes window by window, dealt by content."""
    lists = asked.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("h", "at", "n", "crowd")).alias("asked"))  # at most a document's segments
    both = texts.join(lists.withColumnsRenamed({"doc_id": "a_id", "tie": "a_tie"}), texts["doc_id"].eqNullSafe(F.col("a_id")) & (texts["tie"] == F.col("a_tie")))
    both = both.select("doc_id", "tie", "text", "asked")

    def run(batches):
        for b in text_slices(batches, SLICE):
            raw, offsets = utf8_parts(b.column(2))
            lists = b.column(3)
            doc = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            flat = lists.flatten()
            h, at, n, crowd = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            if not len(doc):
                continue
            ids, ties = b.column(0), b.column(1).to_numpy()
            begin = offsets[doc] + at
            plain = crowd == 0
            for some in np.array_split(np.flatnonzero(plain), max(1, int(n[plain].sum() + 99 * plain.sum()) >> 22)):
                size = n[some].astype(np.int64) + WINDOW - 1
                ends = np.cumsum(size)
                index = np.repeat(begin[some] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
                data = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32).tobytes()), pa.py_buffer(raw[index].tobytes())])
                yield _batch(_SEEN, h[some], ids.take(pa.array(doc[some])), ties[doc[some]], at[some], n[some], np.zeros(len(some), dtype=np.int32), data)
            if plain.all():
                continue
            rank = _order_of(ids, ties)
            todo = np.flatnonzero(~plain)
            for some in np.array_split(todo, max(1, int((n[todo] + WINDOW).sum()) >> 20)):
                strings = [raw[begin[i] : begin[i] + n[i] + WINDOW - 1] for i in some]
                classes, which, offset = equal_windows(strings, WINDOW)
                seg = some[which]
                first, gone = _elect(classes, rank[doc[seg]], at[seg] + offset)
                s, place = seg[first], at[seg[first]] + offset[first]
                data = np.lib.stride_tricks.sliding_window_view(raw, WINDOW)[begin[s] + offset[first]]
                part = mix((data.astype(np.uint64) * _WEIGHTS).sum(axis=1)) % crowd[s].astype(np.uint64)
                data = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WINDOW), len(s), [None, pa.py_buffer(np.ascontiguousarray(data).tobytes())]).cast(pa.binary())
                yield _batch(_SEEN, h[s], ids.take(pa.array(doc[s])), ties[doc[s]], place, np.ones(len(s), dtype=np.int32), part.astype(np.int32), data)
                if gone.any():
                    d, a, m = _merged(doc[seg[gone]], at[seg[gone]] + offset[gone], np.ones(int(gone.sum()), dtype=np.int64))
                    yield _batch(_SEEN, pa.nulls(len(d), pa.int64()), ids.take(pa.array(d)), ties[d], a, m, np.zeros(len(d), dtype=np.int32), pa.nulls(len(d), pa.binary()))

    return both.mapInArrow(run, _ddl(_SEEN))


_WEIGHTS = np.random.Generator(np.random.PCG64(0xC0DE)).integers(1, 1 << 63, size=WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _elect(classes: np.ndarray, rank: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each class the entry that starts earliest, and those that are removed (not further entries of that place)."""
    by = np.lexsort((place, rank, classes))
    c, r, p = classes[by], rank[by], place[by]
    new = np.ones(len(c), dtype=bool)
    new[1:] = c[1:] != c[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(len(c)), 0))
    first, gone = np.zeros(len(c), dtype=bool), np.zeros(len(c), dtype=bool)
    first[by] = new
    gone[by] = ~new & ((r != r[head]) | (p != p[head]))
    return first, gone


def sort_blocks(seen: DataFrame) -> DataFrame:
    """Windows that are not the earliest of their class, by suffix arrays over blocks of whole hashes."""
    dealt = seen.repartition("h", "part").sortWithinPartitions("h", "part")

    def work(rows: pa.Table):
        rows = rows.combine_chunks().to_batches()[0]
        ids, ties = rows.column(1), rows.column(2).to_numpy()
        rank, at = _order_of(ids, ties), rows.column(3).to_numpy()
        data = rows.column(6)
        offsets = np.frombuffer(data.buffers()[1], dtype=np.int32)[data.offset : data.offset + len(data) + 1]
        raw = np.frombuffer(data.buffers()[2], dtype=np.uint8)
        classes, which, offset = equal_windows([raw[a:b] for a, b in zip(offsets[:-1], offsets[1:])], WINDOW)
        several = np.bincount(classes, minlength=int(classes.max()) + 1 if len(classes) else 1)[classes] > 1
        classes, which, offset = classes[several], which[several], offset[several]
        _, gone = _elect(classes, rank[which], at[which] + offset)
        if gone.any():
            d, a, m = _merged(which[gone], (at[which] + offset)[gone], np.ones(int(gone.sum()), dtype=np.int64))
            yield _batch(_GONE, ids.take(pa.array(d)), ties[d], a, m)

    def run(batches):
        held, size = [], 0
        for b in batches:
            while b.num_rows:
                h, part = b.column(0).to_numpy(), b.column(5).to_numpy()
                change = np.flatnonzero((h[1:] != h[:-1]) | (part[1:] != part[:-1])) + 1
                lens = np.diff(np.frombuffer(b.column(6).buffers()[1], dtype=np.int32)[b.column(6).offset : b.column(6).offset + b.num_rows + 1])
                upto = np.cumsum(lens)
                if held and (held[-1].column(0)[-1].as_py(), held[-1].column(5)[-1].as_py()) != (int(h[0]), int(part[0])) and size >= BLOCK:
                    yield from work(pa.Table.from_batches(held))
                    held, size = [], 0
                end = next((int(c) for c in change if size + upto[c - 1] >= BLOCK), b.num_rows)
                held.append(b.slice(0, end))
                size += int(upto[end - 1])
                b = b.slice(end)
                if b.num_rows:
                    yield from work(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            yield from work(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, _ddl(_GONE))


def _apply(texts: DataFrame, gone: DataFrame, keep_text: bool) -> DataFrame:
    """Removes the bytes of all windows ``gone(doc_id, tie, at, n)`` from ``texts(doc_id, tie, text, copies)``."""
    lists = gone.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("at", "n")).alias("gone"))  # at most a document's windows
    both = texts.join(lists.withColumnsRenamed({"doc_id": "g_id", "tie": "g_tie"}), texts["doc_id"].eqNullSafe(F.col("g_id")) & (texts["tie"] == F.col("g_tie")), "left")
    both = both.select("doc_id", "text", "copies", "gone")
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(kind))])
    schema = pa.schema([*schema, ("kept", pa.binary())]) if keep_text else schema
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>" + (", kept binary" if keep_text else "")
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches):
        for b in text_slices(batches, SLICE):
            raw, offsets = utf8_parts(b.column(1))
            copies, lists = b.column(2).to_pylist(), b.column(3)
            at, n = (lists.flatten().field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(2))
            bound = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            has = lists.is_valid().to_numpy(zero_copy_only=False)
            out = [[] for _ in schema]

            def put(*values):
                for c, v in zip(out, values):
                    c.append(v)

            for i, doc in enumerate(b.column(0).to_pylist()):
                text = raw[offsets[i] : offsets[i + 1]]
                spans = np.zeros((0, 2), dtype=np.int64)
                if has[i] and bound[i + 1] > bound[i]:
                    a = at[bound[i] : bound[i + 1]]
                    e = a + n[bound[i] : bound[i + 1]] + WINDOW - 1
                    by = np.argsort(a)
                    a, e = a[by], np.maximum.accumulate(e[by])
                    new = np.append(True, a[1:] > e[:-1])
                    spans = np.stack([a[new], e[np.append(np.flatnonzero(new)[1:] - 1, len(e) - 1)]], axis=1)
                keep, hashed, last = [], hashlib.sha256(), 0
                for s, e in [*spans.tolist(), (len(text), len(text))]:
                    hashed.update(text[last:s].tobytes())
                    if keep_text:
                        keep.append(text[last:s].tobytes())
                    last = e
                gone = int((spans[:, 1] - spans[:, 0]).sum())
                put(doc, len(text), gone, len(spans), hashed.hexdigest(), [{"start": s, "end": e} for s, e in spans.tolist()], b"".join(keep))
                # further rows with this id and text start after the first
                whole = [(doc, len(text), len(text), 1, nothing, [{"start": 0, "end": len(text)}], b"")] if len(text) >= WINDOW else [tuple(c[-1] for c in out)]
                for _ in range(copies[i] - 1):
                    put(*whole[0])
                    if len(out[0]) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)
                        out = [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return both.mapInArrow(run, ddl)


def dedup(docs: DataFrame, keep_text: bool = False, crowd: int = CROWD) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` and, if asked for, ``kept``.

    A byte goes if a window of ``WINDOW`` bytes over it also starts earlier: in a
    document of smaller id (null behind all ids; rows that share an id are ordered by
    a hash of their text, and of rows equal in both one is the first), or earlier in
    its own document.  Windows are compared on the input and never cross documents.  Null texts are
    empty; texts shorter than a window keep everything; spans are byte ranges; kept
    bytes may begin within a character; an empty table gives no rows; other columns
    are not read.
    """
    ws = Workspace(docs.sparkSession, "suffixdedup")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    found = ws.save(compare(cut(rows)), "found")
    asked = found.where(F.col("h").isNotNull())
    per = asked.groupBy("h").agg(F.count("*").alias("many")).where(F.col("many") > crowd)
    per = per.select(F.col("h").alias("crowd_h"), F.ceil(F.col("many") * 64 / crowd).cast("int").alias("crowd"))
    asked = asked.join(per, asked["h"] == per["crowd_h"], "left").select(*_FOUND.names, F.coalesce("crowd", F.lit(0)).alias("crowd"))
    # of rows equal in id and text one stands for all: a copied row weighs no more than another
    texts = rows.groupBy("doc_id", "tie").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    seen = fetch(asked, texts.select("doc_id", "tie", "text"))
    dropped = found.where(F.col("h").isNull()).select(*_GONE.names)
    if not per.isEmpty():  # only crowded hashes find windows to remove while they are fetched
        seen = ws.save(seen, "seen")
        dropped = dropped.unionByName(seen.where(F.col("h").isNull()).select(*_GONE.names))
    gone = ws.save(sort_blocks(seen.where(F.col("h").isNotNull())).unionByName(dropped), "gone")
    return _apply(texts, gone, keep_text)
