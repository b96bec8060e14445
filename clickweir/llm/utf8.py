"""Texts of an Arrow batch as bytes, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
LOWER = np.arange(256, dtype="u1")
LOWER[65:91] += 32


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each text starts; null is empty."""
    if not len(texts):
        return np.zeros(0, "u1"), np.zeros(1, "i8")
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    kind = "i8" if pa.types.is_large_string(texts.type) else "i4"
    at = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype("i8")
    bytes_ = np.frombuffer(data, "u1") if data is not None and data.size else np.zeros(0, "u1")
    return bytes_[at[0]:at[-1]], at - at[0]


def pieces(texts: pa.Array, size: int = PIECE_BYTES, most: int = 4096) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, bytes, starts) of runs of at most `most` whole texts, `size` bytes or one text each."""
    data, at = utf8(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + size, "right")) - 1)
        last = min(last, first + most)
        yield slice(first, last), data[at[first]:at[last]], at[first:last + 1] - at[first]
        first = last


def owner(starts: np.ndarray) -> np.ndarray:
    """For each byte of a piece the number of its text."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))
