"""Token-id files in patched frame-of-reference blocks.

Ids of consecutive texts form one stream, cut into blocks of 128.  A block keeps
its minimum, the differences at a bit width that fits a chosen percentile of
them, and a list of exceptions (position, difference) for the rest.  An index
holds where each block starts, a table each text's id and length.

Layout, all little-endian: ``LKID0001``; blocks; block starts (uint64, one more
than blocks); doc ids (int64, the least value for null); lengths (uint64); footer
of uint64 block count, id count, text count, byte offset of the starts; magic.
A block: uint32 minimum, uint8 width, uint8 exceptions, packed differences,
exception positions (uint8), exception differences (uint32).
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenizing import tokenizing
from .workspace import Workspace, text_slices

MAGIC = b"LKID0001"
BLOCK = 128
PERCENTILE = 98
#: Blocks that are packed or unpacked at a time.
AT_ONCE = 4096
NULL_ID = -(1 << 63)


def _width(x: np.ndarray) -> np.ndarray:
    """Bit length of each value."""
    out = np.zeros(len(x), dtype=np.int64)
    for s in (16, 8, 4, 2, 1):
        big = x >> np.uint32(s) > 0
        out[big] += s
        x = np.where(big, x >> np.uint32(s), x)
    return out + (x > 0)


def _pack(d: np.ndarray, w: int) -> np.ndarray:
    """The w low bits of each of a block's values, least significant first; w * BLOCK / 8 bytes a row."""
    kind = "<u2" if w <= 16 else "<u4"
    full = np.dtype(kind).itemsize * 8
    low = d & np.uint32((1 << w) - 1)
    bits = np.unpackbits(np.ascontiguousarray(low.astype(kind)).view(np.uint8), axis=1, bitorder="little")
    return np.packbits(bits.reshape(len(d), BLOCK, full)[:, :, :w].reshape(len(d), -1), axis=1, bitorder="little")


def _unpack(raw: np.ndarray, w: int) -> np.ndarray:
    kind = "<u2" if w <= 16 else "<u4"
    full = np.dtype(kind).itemsize * 8
    bits = np.zeros((len(raw), BLOCK, full), dtype=np.uint8)
    if w:
        bits[:, :, :w] = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(raw), BLOCK, w)
    return np.packbits(bits.reshape(len(raw), -1), axis=1, bitorder="little").view(kind).astype(np.uint32)


def pack_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> list[bytes]:
    """Encoded blocks of a stream of uint32; the last block is padded with its first value."""
    out: list[bytes] = []
    for lo in range(0, len(ids), BLOCK * AT_ONCE):
        part = ids[lo : lo + BLOCK * AT_ONCE]
        short = -len(part) % BLOCK
        if short:
            part = np.concatenate([part, np.full(short, part[len(part) // BLOCK * BLOCK], dtype=np.uint32)])
        grid = part.reshape(-1, BLOCK)
        least = grid.min(axis=1)
        diff = grid - least[:, None]
        rank = min(BLOCK - 1, BLOCK * percentile // 100)
        width = _width(np.partition(diff, rank, axis=1)[:, rank])
        blocks: list[bytes] = [b""] * len(grid)
        for w in np.unique(width).tolist():
            rows = np.flatnonzero(width == w)
            d = diff[rows]
            packed = _pack(d, w)
            over = d >> np.uint32(w) > 0 if w < 32 else np.zeros(d.shape, dtype=bool)
            row, col = np.nonzero(over)
            n = np.bincount(row, minlength=len(rows))
            head = np.empty((len(rows), 6), dtype=np.uint8)
            head[:, :4] = least[rows].astype("<u4").view(np.uint8).reshape(-1, 4)
            head[:, 4], head[:, 5] = w, n
            head = np.concatenate([head, packed], axis=1)
            size, body = head.shape[1], head.tobytes()
            at, value = col.astype(np.uint8).tobytes(), d[row, col].astype("<u4").tobytes()
            hi = np.cumsum(n).tolist()
            lo_ = 0
            for j, (r, end) in enumerate(zip(rows.tolist(), hi)):
                blocks[r] = body[j * size : (j + 1) * size] + at[lo_:end] + value[4 * lo_ : 4 * end]
                lo_ = end
        out += blocks
    return out


def unpack_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ids of whole blocks that begin at ``starts`` in ``data`` (uint8)."""
    n = len(starts)
    out = np.empty((n, BLOCK), dtype=np.uint32)
    head = data[starts[:, None] + np.arange(6)]
    least = head[:, :4].copy().view("<u4")[:, 0]
    width, extra = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        size = BLOCK // 8 * w
        raw = data[starts[rows][:, None] + 6 + np.arange(size)]
        out[rows] = _unpack(raw, w)
    at = starts + 6 + BLOCK // 8 * width
    row = np.repeat(np.arange(n), extra)
    k = np.arange(len(row)) - np.repeat(np.cumsum(extra) - extra, extra)
    value = data[(at[row] + extra[row] + 4 * k)[:, None] + np.arange(4)].copy().view("<u4")[:, 0]
    out[row, data[at[row] + k]] = value
    return (out + least[:, None]).reshape(-1)


class IdFileWriter:
    """Writes one file; texts are added in order."""

    def __init__(self, sink):
        self.sink, self.at = sink, len(MAGIC)
        sink.write(MAGIC)
        self.starts: list[int] = []
        self.docs: list[int] = []
        self.lengths: list[int] = []
        self._held: list[bytes] = []
        self._size = 0
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids``: little-endian uint32."""
        self.docs.append(NULL_ID if doc_id is None else doc_id)
        self.lengths.append(len(ids) // 4)
        self._held.append(ids)
        self._size += len(ids)
        if self._size >= 4 * BLOCK * AT_ONCE:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self._held), dtype="<u4")
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        for block in pack_blocks(ids[:whole]):
            self.starts.append(self.at)
            self.sink.write(block)
            self.at += len(block)
        self.n_ids += whole
        rest = ids[whole:].tobytes()
        self._held, self._size = [rest], len(rest)

    def close(self) -> None:
        self._flush(True)
        index = self.at
        self.sink.write(np.array([*self.starts, self.at], dtype="<u8").tobytes())
        self.sink.write(np.array(self.docs, dtype="<i8").tobytes())
        self.sink.write(np.array(self.lengths, dtype="<u8").tobytes())
        self.sink.write(struct.pack("<4Q", len(self.starts), self.n_ids, len(self.docs), index) + MAGIC)


class IdFileReader:
    """Reads a file by parts: texts in order, or any range of ids through the block index."""

    def __init__(self, source):
        self.source = source
        size = source.size() if hasattr(source, "size") else source.seek(0, io.SEEK_END)
        foot = self._at(size - 40, 40)
        if foot[32:] != MAGIC or self._at(0, 8) != MAGIC:
            raise ValueError("not a token-id file")
        self.n_blocks, self.n_ids, self.n_docs, index = struct.unpack("<4Q", foot[:32])
        table = self._at(index, size - 40 - index)
        n = self.n_blocks + 1
        self.starts = np.frombuffer(table, dtype="<u8", count=n).astype(np.int64)
        self.docs = np.frombuffer(table, dtype="<i8", count=self.n_docs, offset=8 * n)
        self.lengths = np.frombuffer(table, dtype="<u8", count=self.n_docs, offset=8 * (n + self.n_docs)).astype(np.int64)

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo to hi - 1 of the stream; only their blocks are read."""
        if hi <= lo:
            return np.zeros(0, dtype=np.uint32)
        a, b = lo // BLOCK, -(-hi // BLOCK)
        first = int(self.starts[a])
        data = np.frombuffer(self._at(first, int(self.starts[b]) - first), dtype=np.uint8)
        return unpack_blocks(data, self.starts[a:b] - first)[lo - a * BLOCK : hi - a * BLOCK]

    def texts(self):
        """(doc_id or None, ids) of every text, in order."""
        ends = np.cumsum(self.lengths)
        held, lo, hi = np.zeros(0, dtype=np.uint32), 0, 0
        for doc, n, end in zip(self.docs.tolist(), self.lengths.tolist(), ends.tolist()):
            if end > hi:
                upto = min(self.n_ids, max(end, hi + BLOCK * AT_ONCE))
                held, lo, hi = np.concatenate([held[end - n - lo :], self.ids(hi, upto)]), end - n, upto
            yield None if doc == NULL_ID else doc, held[end - n - lo : end - lo]


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_files(docs: DataFrame, path: str, folder: str, end_id: int) -> list[tuple[str, int, int]]:
    """Encodes ``docs(doc_id, text)`` and writes id files in ascending doc_id order.

    Each text's ids are followed by ``end_id``.  Rows are dealt to files by doc_id
    range; equal doc_ids are ordered by text, null doc_ids come first.  A task
    writes under a name of its own and renames, so a repeated task replaces the
    file whole.  Returns (uri, texts, ids) of each file, in order: one row a file.
    """

    def run(batches):
        from pyspark import TaskContext

        tok = tokenizing(path)
        end = struct.pack("<I", end_id)
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}.ids"
        files, at = _fs(name)
        files.create_dir(at.rpartition("/")[0], recursive=True)
        draft = f"{at}.{uuid.uuid4().hex}"
        with files.open_output_stream(draft) as sink:
            w = IdFileWriter(sink)
            for b in text_slices(batches):
                ids = tok.encode([t or "" for t in b.column(1).to_pylist()])
                for doc, x in zip(b.column(0).to_pylist(), ids):
                    w.add(doc, x + end)
            w.close()
        files.move(draft, at)
        yield pa.RecordBatch.from_pylist([{"part": part, "uri": name, "texts": len(w.docs), "ids": w.n_ids}])

    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    made = dealt.mapInArrow(run, "part long, uri string, texts long, ids long").collect()
    return [(r["uri"], r["texts"], r["ids"]) for r in sorted(made, key=lambda r: r["part"]) if r["texts"]]


def read_files(spark, files: list[tuple[str, int, int]]) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every text in the files of :func:`write_files`."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    rows, start = [], 0
    for uri, _, n in files:
        rows.append((uri, start))
        start += n
    if not rows:
        return spark.createDataFrame([], schema)

    def run(batches):
        for b in batches:
            for uri, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                files, name = _fs(uri)
                with files.open_input_file(name) as source:
                    reader, out = IdFileReader(source), []
                    for doc, ids in reader.texts():
                        out.append((doc, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        at += len(ids)
                        if len(out) == 10_000:
                            yield _rows(out)
                            out = []
                    yield _rows(out)

    def _rows(out):
        cols = list(zip(*out)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # one row a file: the list is as long as the writing job had tasks
    return spark.createDataFrame(rows, "uri string, start long").repartition(len(rows), F.col("start")).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, end_id: int, folder: str | None = None) -> DataFrame:
    """Writes ``docs`` to id files, and returns what reading them back gives, per text."""
    spark = docs.sparkSession
    folder = folder or Workspace(spark, "idfile").folder("ids")
    return read_files(spark, write_files(docs, path, folder, end_id))
