"""Pairs of mates that overlap: the offset of one on the other, adapters cut by it, bases corrected, reads merged."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import ragged

_COMPLEMENT = bytes.maketrans(b"ACGTNacgtn", b"TGCANtgcan")
_OTHER = np.frombuffer(_COMPLEMENT, np.uint8)
#: Letters of either mate that are worked on at a time, padded; bases that are compared first.
CELLS, HEAD = 1 << 18, 24
#: What no letter is, beyond the end of a first and of a second mate.
_PAD = (0xFF, 0xFE)


def best_offset(a: np.ndarray, b: np.ndarray, least: int, most: int, share: float) -> tuple[int, int, int] | None:
    """Where the reversed mate b lies on a without gaps: offset (below 0 where b begins before a), length and mismatches.

    At least `least` bases must overlap, with `most` mismatches at most and no more than a `share` of them. Of several offsets that
    of the lowest share of mismatches counts, then that of the longest overlap, then the smallest.
    """
    offsets = np.arange(least - len(b), len(a) - least + 1)
    if not len(offsets) or min(len(a), len(b)) < least:
        return None
    at = np.arange(len(a))
    inside = at[None, :] - offsets[:, None]  # the place in b of each base of a
    on = (inside >= 0) & (inside < len(b))
    size = on.sum(axis=1)
    unlike = (on & (a[None, :] != b[np.clip(inside, 0, len(b) - 1)])).sum(axis=1)
    good = np.flatnonzero((size >= least) & (unlike <= most) & (unlike <= share * size))
    if not len(good):
        return None
    best = good[np.lexsort((offsets[good], -size[good], unlike[good] / size[good]))[0]]
    return int(offsets[best]), int(size[best]), int(unlike[best])


def _pair(s1: str, q1: str, s2: str, q2: str, limits: tuple[int, int, float], correct: bool, high: int, low: int) -> tuple:
    a, b = s1.encode(), s2.encode().translate(_COMPLEMENT)[::-1]
    found = best_offset(np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8), *limits)
    if found is None:
        return None, None, None, None, 0, s1, q1, s2, q2, None, None
    offset, size, unlike = found
    insert = offset + len(b)  # from the first base of a to the last of the reversed mate
    a, qa = bytearray(a[:insert]), bytearray(q1.encode()[:insert])
    b, qb = bytearray(b[max(0, -offset) :]), bytearray(q2.encode()[::-1][max(0, -offset) :])
    shift, fixed = max(0, offset), 0
    if correct and unlike:
        for i in range(min(len(a) - shift, len(b))):
            if a[shift + i] != b[i]:
                x, y = qa[shift + i] - 33, qb[i] - 33
                if x >= high and y <= low:
                    b[i], qb[i], fixed = a[shift + i], qa[shift + i], fixed + 1
                elif y >= high and x <= low:
                    a[shift + i], qa[shift + i], fixed = b[i], qb[i], fixed + 1
    done = len(a) - shift
    merged, quality = (bytes(a + b[done:]), bytes(qa + qb[done:]))
    mate, mate_quality = bytes(b).translate(_COMPLEMENT)[::-1], bytes(qb)[::-1]
    return offset, size, unlike, insert, fixed, a.decode(), qa.decode(), mate.decode(), mate_quality.decode(), merged.decode(), quality.decode()


def _square(letters: np.ndarray, size: np.ndarray, pad: int, flip: bool = False) -> np.ndarray:
    """A row for each text, padded at its end; flipped texts begin with their last letter."""
    wide = int(size.max(initial=0))
    out = np.full((len(size), wide), pad, np.uint8)
    out[np.arange(wide) >= wide - size[:, None] if flip else np.arange(wide) < size[:, None]] = letters
    return out[:, ::-1] if flip else out


def _texts(rows: np.ndarray, size: np.ndarray) -> pa.Array:
    """The first letters of each row as texts."""
    return ragged.texts(rows[np.arange(rows.shape[1]) < size[:, None]], size)


def best_offsets(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, least: int, most: int, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """best_offset of many pairs, a row each, padded by _PAD: offsets, lengths (0 without an overlap) and mismatches.

    At each offset the first bases of all pairs are compared, and the others of those pairs only that have few mismatches there.
    """
    long_a, long_b = a.shape[1], b.shape[1]
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    offset, length, wrong = np.zeros((3, len(size_a)), np.int64)
    for d in range(least - long_b, long_a - least + 1):
        low, high = max(0, d), min(long_a, d + long_b)
        size = np.minimum(size_a, size_b + d) - low
        most_here = most + (high - low) - size  # what lies beyond a mate's end never agrees
        head = min(low + HEAD, high)
        unlike = (a[low:head] != b[low - d : head - d]).view(np.uint8).sum(axis=0, dtype=np.uint8)
        at = np.flatnonzero((unlike <= most_here) & (size >= max(least, 1)))
        if not len(at):
            continue
        unlike = unlike[at].astype(np.int64)
        for i in range(head, high, 255):
            j = min(i + 255, high)
            unlike += (a[i:j, at] != b[i - d : j - d, at]).view(np.uint8).sum(axis=0, dtype=np.uint8)
        size = size[at]
        unlike -= (high - low) - size
        left, right = unlike * length[at], wrong[at] * size
        better = (unlike <= most) & (unlike <= share * size) & ((length[at] == 0) | (left < right) | (left == right) & (size > length[at]))
        at = at[better]
        offset[at], length[at], wrong[at] = d, size[better], unlike[better]
    return offset, length, wrong


def _pairs(part: list[pa.Array], limits: tuple[int, int, float], correct: bool, high: int, low: int) -> list[pa.Array]:
    """_pair of many pairs of ASCII letters: the same eleven columns."""
    known = np.ones(len(part[0]), bool)
    for c in part:
        known &= c.is_valid().to_numpy(zero_copy_only=False)
    (s1, n1), (q1, m1), (s2, n2), (q2, m2) = (ragged.letters(pc.fill_null(c, "")) for c in part)
    a, qa, c, qc, b, qb = _square(s1, n1, _PAD[0]), _square(q1, m1, 0), _square(s2, n2, _PAD[1]), _square(q2, m2, 0), _square(_OTHER[s2], n2, _PAD[1], flip=True), _square(q2, m2, 0, flip=True)
    offset, length, unlike = best_offsets(a, b, n1, n2, *limits)
    found = (length > 0) & known
    insert = np.where(found, offset + n2, 0)
    used_a, used_b = np.minimum(n1, insert), np.where(found, n2 - np.maximum(0, -offset), 0)
    fixed = np.zeros(len(found), np.int64)
    if correct:
        rows = np.flatnonzero(found & (unlike > 0))
        i = np.arange(int(length[rows].max(initial=0)))
        on_a, on_b = i + np.maximum(0, offset[rows])[:, None], i + np.maximum(0, -offset[rows])[:, None]
        inside = i < length[rows][:, None]
        r, k = np.nonzero(inside & (a[rows[:, None], np.where(inside, on_a, 0)] != b[rows[:, None], np.where(inside, on_b, 0)]))
        on_a, on_b, r = on_a[r, k], on_b[r, k], rows[r]
        x, y = qa[r, on_a].astype(int) - 33, qb[r, on_b].astype(int) - 33
        second, first = (x >= high) & (y <= low), (y >= high) & (x <= low)
        first &= ~second
        u, at, to = r[second], on_a[second], on_b[second]
        b[u, to], qb[u, to], c[u, n2[u] - 1 - to], qc[u, n2[u] - 1 - to] = a[u, at], qa[u, at], _OTHER[a[u, at]], qa[u, at]
        u, at, to = r[first], on_a[first], on_b[first]
        a[u, at], qa[u, at] = b[u, to], qb[u, to]
        fixed += np.bincount(r[first | second], minlength=len(fixed))
    wide = int(insert.max(initial=0))
    place, rest = np.arange(wide), np.arange(b.shape[1])
    later = (place >= used_a[:, None]) & (place < insert[:, None])  # what only the second mate has
    from_b = (rest >= np.where(found, used_a - offset, b.shape[1])[:, None]) & (rest < n2[:, None])
    merged, quality = np.zeros((2, len(found), wide), np.uint8)
    for to, x, y in ((merged, a, b), (quality, qa, qb)):
        to[:, : x.shape[1]] = x[:, :wide]
        to[later] = y[from_b]
    number = lambda x: pa.array(x, pa.int32(), mask=~found)
    cut = [pc.if_else(pa.array(found), _texts(x, n), old) for x, n, old in ((a, used_a, part[0]), (qa, used_a, part[1]), (c, used_b, part[2]), (qc, used_b, part[3]))]
    none = pa.nulls(len(found), pa.string())
    return [number(offset), number(length), number(unlike), number(insert), pa.array(fixed, pa.int32()), *cut, *(pc.if_else(pa.array(found), _texts(x, insert), none) for x in (merged, quality))]


def overlap_mates(pairs: DataFrame, least: int = 30, most: int = 5, share: float = 0.2, correct: bool = True, high: int = 30, low: int = 14) -> DataFrame:
    """Pairs (name, seq1, qual1, seq2, qual2) by the overlap of the two mates: name, offset, overlap, mismatches, insert, corrected, the
    reads, merged_seq, merged_qual.

    What a read has beyond the insert is adapter and goes. Where the mates differ, a base of quality `high` or more takes the place of
    one of `low` or less. The merged read is the insert: the first mate, then what only the second has. A pair without an
    overlap (see best_offset) stays as it is, with nulls for what is known of overlaps only; so does one with a null read. Rows that repeat are
    treated alike.
    """
    columns = ["seq1", "qual1", "seq2", "qual2"]
    schema = "name string, offset int, overlap int, mismatches int, insert int, corrected int, seq1 string, qual1 string, seq2 string, qual2 string, merged_seq string, merged_qual string"
    names, kinds = [c.split(" ")[0] for c in schema.split(", ")], [pa.string(), *[pa.int32()] * 5, *[pa.string()] * 6]
    limits = (least, most, share)

    def singly(reads: list[pa.Array]) -> list[pa.Array]:
        rows = [(None, None, None, None, 0, *r, None, None) if None in r else _pair(*r, limits, correct, high, low) for r in zip(*(c.to_pylist() for c in reads), strict=True)]
        return [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds[1:], strict=True)]

    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            named, *reads = (c.cast(pa.string()) for c in batch.columns)
            for s, q in (reads[:2], reads[2:]):
                two = pc.and_(pc.not_equal(pc.utf8_length(s), pc.utf8_length(q)), pc.and_(*(pc.and_(pc.is_valid(x), pc.is_valid(y)) for x, y in (reads[:2], reads[2:]))))
                if pc.any(two).as_py():
                    raise ValueError(f"a sequence and a quality of two lengths: {named.filter(two)[0]}")
            size = np.maximum(*(pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False) for c in (reads[0], reads[2])))
            plain = all(pc.all(pc.string_is_ascii(c)).as_py() in (True, None) for c in reads)
            # Rows by length, so that few letters are padding.
            order = None if not len(size) or size.min() == size.max() else np.argsort(size, kind="stable")
            if order is not None:
                named, reads, size = named.take(pa.array(order)), [c.take(pa.array(order)) for c in reads], size[order]
            at = 0
            while at < len(size):
                n = min(len(size) - at, max(1, CELLS // max(1, int(size[at]))))
                while n > 1 and n * int(size[at + n - 1]) > CELLS:
                    n = max(1, min(n - 1, CELLS // int(size[at + n - 1])))
                part = [c.slice(at, n) for c in reads]
                yield pa.RecordBatch.from_arrays([named.slice(at, n), *(_pairs(part, limits, correct, high, low) if plain else singly(part))], names)
                at += n

    return pairs.select(F.col("name").cast("string").alias("name"), *columns).mapInArrow(of, schema)


def insert_sizes(overlapped: DataFrame) -> DataFrame:
    """insert, n: how many pairs have an insert of each size; null for those without an overlap."""
    return overlapped.groupBy("insert").agg(F.count(F.lit(1)).alias("n"))
