"""LZ4 frames for tests."""

import pyarrow as pa


def frame(data: bytes) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.CompressedOutputStream(sink, "lz4") as s:
        s.write(data)
    return sink.getvalue().to_pybytes()
