"""Pieces of different lengths in one byte array, taken apart and put together by numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def places(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indexes of all bytes of the pieces [begin, begin + length), one piece after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(begin - (ends - length), length)


def offsets(length: np.ndarray) -> np.ndarray:
    return np.concatenate((np.zeros(1, np.int64), np.cumsum(length)))


def strings(data: np.ndarray, length: np.ndarray) -> pa.StringArray:
    """Texts of consecutive bytes."""
    ends = offsets(length)
    if ends[-1] >= 1 << 31:
        raise ValueError("a batch of texts is over 2 GB")
    return pa.StringArray.from_buffers(len(length), pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data, np.uint8)))


def pieces(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes one after the other, length of each) of an array of texts or bytes; null is empty."""
    array = array.fill_null("" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"") if array.null_count else array
    kind = np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32
    _, ends, data = array.buffers()
    at = np.frombuffer(ends, kind)[array.offset : array.offset + len(array) + 1].astype(np.int64) if ends is not None else np.zeros(len(array) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], np.diff(at)
