"""Bounds of what a Python task holds at once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

BATCH_ROWS = 256
BATCH_BYTES = 1 << 20


def small_batches(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows; the buffers are shared."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def sized_batches(batch: pa.RecordBatch, column: int, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with at most ``most`` bytes in a text column, or of one longer row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)
