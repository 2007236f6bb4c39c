"""Arrow batches of texts in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once inside a task; a single longer text is a piece of its own.
PIECE_BYTES = 2 << 20


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of the batches whose texts in ``column`` add up to about ``limit`` bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def strings(column: pa.Array) -> list[str]:
    """Python strings; null is the empty text."""
    return ["" if x is None else x for x in column.to_pylist()]


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts' UTF-8 bytes one after the other, and the n + 1 places where each begins."""
    flat = pc.cast(pc.fill_null(column, ""), pa.large_binary())
    offsets = np.frombuffer(flat.buffers()[1], dtype=np.int64)[flat.offset : flat.offset + len(flat) + 1]
    data = flat.buffers()[2]
    if data is None or not len(offsets) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]
