"""Whole texts as bytes, for work on Arrow batches inside tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def byte_table(to_space: bytes) -> bytes:
    """A table for ``bytes.translate``: A-Z in lower case, ``to_space`` as spaces."""
    table = bytearray(ASCII_LOWER.get(c, c) for c in range(256))
    for c in to_space:
        table[c] = 0x20
    return bytes(table)


def bytes_of(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The UTF-8 bytes of a string column, and where each row begins and ends. Null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return memoryview(data if data is not None else b""), ends


def parts(batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, or one longer row."""
    for batch in batches:
        _, ends = bytes_of(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(ends, ends[begin] + most, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end
