"""Text columns as NumPy bytes, inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# The white space that parts words.
SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
# Bytes of text worked on at once; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins (one more entry marks the end); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1 + column.offset)[column.offset:]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def pieces(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces of about ``limit`` bytes of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = utf8(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(at, at[first] + limit, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return np.where((raw >= 65) & (raw <= 90), raw | 32, raw)


def list_column(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    """An Arrow list column of ``counts[i]`` consecutive values for row i."""
    ends = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
