"""Texts of an Arrow column as one array of UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """The joined bytes of a text column, with 16 spare zero bytes, and the edges of the texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    first = edges[0] if len(edges) else 0
    data = np.concatenate([data[first : edges[-1] if len(edges) else 0], np.zeros(16, np.uint8)])
    return data, edges - first


def chunks(edges: np.ndarray, most: int):
    """Ranges of texts with about ``most`` bytes together, or one longer text."""
    a = 0
    while a < len(edges) - 1:
        b = max(a + 1, int(np.searchsorted(edges, edges[a] + most, "right")) - 1)
        yield a, b
        a = b
