"""Message values: LZ4 frames and plain bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

LZ4_MAGIC = bytes.fromhex("04224d18")
MOST = 32 << 20
#: Bytes that are asked for at a time.
STEP = 64 << 10
#: Decoded bytes from which on a batch is handed on.
HANDED = 16 << 20


def open_frame(value: bytes | None) -> bytes | None:
    """Content of an LZ4 frame, or the value itself; null where corrupt or over 32 MiB."""
    if value is None or not value.startswith(LZ4_MAGIC):
        return value
    try:
        with pa.CompressedInputStream(pa.BufferReader(value), "lz4") as s:
            # read() never gives back the buffer of a read that fails, readinto() has none of its own
            some, out = bytearray(STEP), bytearray()
            while (n := s.readinto(some)) and len(out) <= MOST:
                out += memoryview(some)[:n]
    except (OSError, pa.ArrowException):
        return None
    return bytes(out) if len(out) <= MOST else None


def _runs(values) -> Iterator[tuple[int, list]]:
    """The decoded values in runs of about HANDED bytes, each with the place it begins at."""
    first, held, out = 0, 0, []
    for i, v in enumerate(values):
        out.append(open_frame(v.as_py()))
        held += len(out[-1] or b"")
        if held >= HANDED:
            yield first, out
            first, held, out = i + 1, 0, []
    if out:
        yield first, out


def decode(messages: DataFrame, column: str = "value") -> DataFrame:
    """``messages`` with the binary ``column`` decoded; other columns stay."""
    at = messages.columns.index(column)

    def run(batches):
        for b in batches:
            for first, values in _runs(b.column(at)):
                cols = list(b.slice(first, len(values)).columns)
                cols[at] = pa.array(values, pa.binary())
                yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)

    return messages.mapInArrow(run, messages.schema)
