"""What a Python worker holds: slices of a batch with a bounded number of bytes, and a clean end of a task."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable

import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20


def slices(batch: pa.RecordBatch, columns: Iterable[int], most: int = SLICE_BYTES):
    """The rows of a batch in parts with about ``most`` bytes of the text columns together, or one longer row."""
    sizes = sum(pc.fill_null(pc.binary_length(batch.column(c)), 0).to_numpy(zero_copy_only=False).astype("int64") for c in columns)
    first, held = 0, 0
    for k, size in enumerate(sizes):
        if held and held + size > most:
            yield batch.slice(first, k - first)
            first, held = k, 0
        held += int(size)
    if first < batch.num_rows:
        yield batch.slice(first)


def release() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: it gives back on its own terms


def released(run):
    """A function over batches that, when its task ends, gives freed memory back to the system.

    Workers are reused by later stages, so what one keeps would count against all of them.
    """

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped
