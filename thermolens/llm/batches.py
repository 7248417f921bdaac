"""Arrow batches cut by bytes, so that a task's memory does not depend on how long texts are."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_bytes(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices whose texts have about ``limit`` bytes together; a longer text has its own slice.
    The column must not hold nulls."""
    sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
    passed = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    start = 0
    while start < len(batch):
        stop = int(np.searchsorted(passed, passed[start] + limit, "right")) - 1
        stop = max(start + 1, stop)
        yield batch.slice(start, stop - start)
        start = stop


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every run, one run after the other."""
    place = np.cumsum(sizes) - sizes
    return np.repeat(starts - place, sizes) + np.arange(int(sizes.sum()))
