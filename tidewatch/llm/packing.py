"""Arrow record batches as compressed bytes, to move packed columns through a shuffle."""

from __future__ import annotations

import pyarrow as pa

OPTIONS = pa.ipc.IpcWriteOptions(compression="zstd")


def pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=OPTIONS) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def pack_columns(**columns) -> bytes:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pack(pa.RecordBatch.from_arrays(arrays, names=list(columns)))


def unpack(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(pa.py_buffer(data)) as source:
        return source.read_next_batch()
