"""Blocks of documents kept as rows of word numbers, and their distinct words dealt out by hash.

Whatever is known of a word (ids, counts) is found once where its hash leads, and comes back to each block in the order in
which the block sent its words.
"""

from __future__ import annotations

import numpy as np
import xxhash
import zstandard
from pyspark import TaskContext

#: Words in a block at most, unless a single text has more.
BLOCK_WORDS = 2_000_000
NO_ID = -(2**63)


def block_number(ordinal: int, *content: bytes) -> int:
    """A number for a task's block of that ordinal with this content. A recomputed task gives the same number to the same
    rows only, so what other tasks know of a block cannot be joined to different rows by mistake."""
    h = xxhash.xxh3_64(np.array([TaskContext.get().partitionId(), ordinal], "<i8").tobytes())
    for part in content:
        h.update(part)
    return h.intdigest() - 2**63


def planes(x: np.ndarray) -> bytes:
    """uint32 values, byte by byte, compressed."""
    return zstandard.compress(x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def from_planes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


def pack(parts: list[bytes]) -> bytes:
    head = np.array([len(parts), *map(len, parts)], "<u4").tobytes()
    return zstandard.compress(head + b"".join(parts), 1)


def unpack(data: bytes) -> list[bytes]:
    raw = zstandard.decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    ends = np.cumsum(np.frombuffer(raw, "<u4", n, 4), dtype=np.int64) + 4 * (n + 1)
    return [raw[a:b] for a, b in zip([4 * (n + 1), *ends[:-1]], ends, strict=True)]


def cuts(offsets: np.ndarray, rows: int, most: int = BLOCK_WORDS):
    """First and last row of each block of a batch whose texts' words start at offsets."""
    at = 0
    while at < rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end
        at = end


def number(words: list[bytes], index: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Numbers by falling frequency: the number of each old index, the part of each number, and the numbers of each part
    in ascending order. words are in the old order."""
    order = np.argsort(-np.bincount(index, minlength=len(words)), kind="stable")
    rank = np.empty(len(words), np.uint32)
    rank[order] = np.arange(len(words))
    home = np.fromiter((xxhash.xxh3_64_intdigest(words[i]) % parts for i in order), np.uint32, len(words))
    by_part = np.argsort(home, kind="stable")
    edges = np.searchsorted(home[by_part], np.arange(parts + 1))
    return rank, home, [(p, by_part[a:b]) for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if b > a]
