"""Texts of many rows as one array of bytes, for work on whole batches in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def letters(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other, and how many each has."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = texts.buffers()[2]
    return np.frombuffer(data, np.uint8, offsets[-1] - offsets[0], offsets[0]) if data and offsets[-1] > offsets[0] else np.zeros(0, np.uint8), np.diff(offsets)


def texts(data: np.ndarray, size: np.ndarray) -> pa.Array:
    """The other way round; the bytes must be ASCII."""
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.string())


def places(at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of the bytes of pieces that begin at `at`, one after the other."""
    return np.repeat(at - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
