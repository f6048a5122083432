"""Removal of repeated byte strings by an enhanced suffix array with its tree of common-prefix intervals.

A suffix array over all bytes would move every suffix. Two observations make it sparse and exact. First, each string of
`length` bytes has an anchor, the smallest hash of its k-byte parts, at the same place in every occurrence; strings
in a row with one anchor form a record, and a record has one digest (128 bits) for all its bytes. Records with equal digests are
repeats of the earliest one. Second, only records whose anchor has other digests too can hold further repeats. Their
bytes are sorted as suffixes, longest common prefixes are scanned with a stack, and intervals of at least `length` bytes
whose left neighbours differ are the maximal repeats, with all their occurrences. Everything but the first occurrence goes.

Records meet by hash of their anchor. A task sends one record of each digest, so passages found in a large share of the
documents arrive once per block; an anchor with more than HOT digests is dealt out string by string instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import block_number
from .common import CHANGED, as_binary, batch_bytes, by_bytes, id_text, mix64, pack_arrays, shuffle_partitions, unpack_arrays, values

LENGTH, PART = 100, 40
BLOCK_BYTES, FLAT = 8_000_000, 1 << 19
HOT, SORT_BYTES = 20_000, 8 << 20
NO_ID = -(2**63)
_INDEX = np.uint64((1 << 21) - 1)
_BASE = 0x9E3779B97F4A7C15
_VALUE = mix64(np.arange(1001, 1257, dtype=np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    up = down = np.zeros(0, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, FLAT + (1 << 12))
            cls.up, cls.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)
        return cls.up[:n], cls.down[:n]


def prefix_hashes(flat: np.ndarray) -> np.ndarray:
    """Polynomial hashes (mod 2^64) of all prefixes."""
    up, _ = _Powers.to(len(flat) + 1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[flat] * up[:-1])])


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = _Powers.to(len(prefix))
    return mix64((prefix[end] - prefix[start]) * down[start])


def string_hashes(flat: np.ndarray, at: np.ndarray, length: int, row: int | None = None) -> np.ndarray:
    """Hashes of flat[at : at+length], from prefixes of `row` bytes at a time (FLAT)."""
    row = row or FLAT
    out, order = np.empty(len(at), np.uint64), np.argsort(at, kind="stable")
    cuts = np.searchsorted(at[order], np.arange(0, len(flat) + row, row))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        if b > a:
            own = at[order[a:b]] - k * row
            out[order[a:b]] = span_hashes(prefix_hashes(flat[k * row : (k + 1) * row + length]), own, own + length)
    return out


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    size = 1
    while 2 * size <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return x if size == w else np.minimum(x[: len(x) - (w - size)], x[w - size :])


def records(flat: np.ndarray, ends: np.ndarray, length: int, part: int) -> dict[str, np.ndarray]:
    """Records of texts put in a row: first and last string (start), anchor, hash of the anchor, digest of the bytes in two halves.

    ends are the texts' ends; flat has at most 2^21 bytes.
    """
    empty = {k: np.zeros(0, t) for k, t in (("first", int), ("last", int), ("anchor", int), ("fp", np.uint64), ("digest", np.uint64), ("check", np.uint64))}
    n = len(flat) - length + 1
    if n < 1:
        return empty
    ok = np.ones(len(flat) + 1, np.int32)
    starts = np.concatenate([[0], ends[:-1]])
    bad = np.zeros(len(flat) + 2, np.int32)
    np.add.at(bad, np.maximum(starts, ends - length + 1), 1)
    np.add.at(bad, ends, -1)
    ok = np.cumsum(bad)[:n] == 0
    prefix = prefix_hashes(flat)
    _, down = _Powers.to(len(prefix))
    h = (prefix[part:] - prefix[:-part]) * down[: len(prefix) - part]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    key = (h & ~_INDEX) | np.arange(len(h), dtype=np.uint64)
    anchor = (_sliding_min(key, length - part + 1)[:n] & _INDEX).astype(np.int64)
    at = np.flatnonzero(ok)
    if not len(at):
        return empty
    own = anchor[at]
    new = np.concatenate([[True], (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)])
    first, last, own = at[new], at[np.append(new[1:], True)], own[new]
    data = flat.tobytes()
    pair = np.frombuffer(b"".join([xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(first.tolist(), (last + length).tolist(), strict=True)]), np.uint64).reshape(-1, 2)
    digest, check = np.ascontiguousarray(pair.T)
    return {"first": first, "last": last, "anchor": own, "fp": mix64(h[own]), "digest": digest, "check": check}


def _pieces(texts: list[bytes], length: int, row: int):
    """Texts in rows of at most `row` bytes or so; longer ones in overlapping pieces: (text numbers, their offsets, rows, ends)."""
    held, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), row):
            piece = t[at : at + row + length - 1]
            if held and size + len(piece) > row:
                yield held
                held, size = [], 0
            held.append((i, at, piece))
            size += len(piece)
    if held:
        yield held


def block_records(texts: list[bytes], length: int, part: int, row: int | None = None) -> dict[str, np.ndarray]:
    """Records of all texts: number of the text, first and last string in it, anchor, hash and digest in two halves."""
    out: dict[str, list[np.ndarray]] = {k: [] for k in ("text", "first", "last", "anchor", "fp", "digest", "check")}
    for held in _pieces(texts, length, row or FLAT):
        ends = np.cumsum([len(p) for _, _, p in held])
        r = records(np.frombuffer(b"".join(p for _, _, p in held), np.uint8), ends, length, part)
        which = np.searchsorted(ends, r["first"], "right")
        shift = np.array([at for _, at, _ in held])[which] - np.concatenate([[0], ends[:-1]])[which]
        for k in ("first", "last", "anchor"):
            out[k].append(r[k] + shift)
        out["text"].append(np.array([i for i, _, _ in held])[which])
        for k in ("fp", "digest", "check"):
            out[k].append(r[k])
    return {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}


def maximal_repeats(lcp: np.ndarray, left: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Common-prefix intervals (first, last, length) of a suffix array with a length of at least `least` and different bytes
    on the left. lcp[i] is the common prefix of suffixes i-1 and i (lcp[0] = 0); a left byte of -1 differs from any."""
    differs = np.concatenate([[0], np.cumsum((left[1:] != left[:-1]) | (left[1:] < 0))]) if len(left) else np.zeros(0, int)
    out, stack = [], [(0, 0)]  # (length, first suffix) of the open intervals, ever longer

    def close(last: int) -> int:
        length, first = stack.pop()
        if length >= least and differs[last] > differs[first]:
            out.append((first, last, length))
        return first

    for i, common in enumerate(lcp.tolist()):
        first = i - 1
        while stack[-1][0] > common:
            first = close(i - 1)
        if stack[-1][0] < common:
            stack.append((common, first))
    while len(stack) > 1:
        close(len(lcp) - 1)
    return out


def _sorted_suffixes(text: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the suffixes text[start : start+size], and the longest common prefix of each with the one before."""
    wide = -(-int(size.max()) // 8) * 8
    if int(start.max()) + wide > len(text):
        text = np.concatenate([text, np.zeros(wide, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(text, wide)[start]
    rows[np.arange(wide) >= size[:, None]] = 0
    words = rows.view(">u8").astype(np.uint64)
    order = np.lexsort(words.T[::-1])
    rows, size = rows[order], size[order]
    unlike = rows[1:] != rows[:-1]
    common = np.where(unlike.any(axis=1), unlike.argmax(axis=1), wide)
    return order, np.concatenate([[0], np.minimum(common, np.minimum(size[1:], size[:-1]))])


def find_repeats(text: np.ndarray, ends: np.ndarray, rank: np.ndarray, base: np.ndarray, length: int, sort_bytes: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of contexts put in a row (their ends), the spans that also start in an earlier one or earlier in the same.

    rank orders the contexts' documents, base is where a context starts in its document. Gives context, start and end.
    """
    starts = np.concatenate([[0], ends[:-1]])
    count = np.maximum(ends - starts - length + 1, 0)
    context = np.repeat(np.arange(len(ends)), count)
    at = starts[context] + np.arange(len(context)) - np.repeat(np.cumsum(count) - count, count)
    hashes = string_hashes(text, at, length)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    partner = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(order) else np.zeros(0, bool)
    order = order[partner]  # strings without a partner are no repeats
    if not len(order):
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    wide = -(-int((ends[context[order]] - at[order]).max()) // 8) * 8
    text, most, out = np.concatenate([text, np.zeros(wide, np.uint8)]), max(2, (sort_bytes or SORT_BYTES) // wide), []
    edges = np.append(np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])), len(order))
    split = int(np.diff(edges).max()) > most  # a group's parts cannot tell what is on the left of all

    def search(own: np.ndarray) -> np.ndarray:
        """Puts out the repeats among these strings; gives those that repeat none."""
        start, of = at[own], context[own]
        sa, lcp = _sorted_suffixes(text, start, ends[of] - start)
        start, of, least_ones = start[sa], of[sa], np.ones(len(own), bool)
        left = np.where((start > starts[of]) & (not split), text[np.maximum(start - 1, 0)].astype(np.int64), -1)
        place = base[of] + start - starts[of]
        for first, last, size in maximal_repeats(lcp, left, length):
            group = slice(first, last + 1)
            keep = np.arange(last - first + 1) != np.lexsort((place[group], rank[of[group]]))[0]
            out.append((of[group][keep], place[group][keep], place[group][keep] + size))
            least_ones[sa[group][keep]] = False
        return own[least_ones]

    k = 0
    while k < len(edges) - 1:
        end = max(k + 1, int(np.searchsorted(edges, edges[k] + most, "right")) - 1)
        own, k = order[edges[k] : edges[end]], end
        if len(own) <= most:
            search(own)
            continue
        own = own[np.lexsort((base[context[own]] + at[own] - starts[context[own]], rank[context[own]]))]
        held, done = own[:0], 0  # the earliest of each string so far meet every further part
        while done < len(own):
            more = max(most - len(held), most // 2)
            held, done = search(np.concatenate([held, own[done : done + more]])), done + more
    return tuple(np.concatenate([x[i] for x in out]) if out else np.zeros(0, np.int64) for i in range(3))


def merged(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that overlap or touch within a text become one; sorted."""
    if not len(text):
        return text, start, end
    order = np.lexsort((start, text))
    text, start, end = text[order].astype(np.int64), start[order].astype(np.int64), end[order].astype(np.int64)
    wide = int(end.max()) + 2
    reach = np.maximum.accumulate(text * wide + end)
    new = np.concatenate([[True], (text * wide + start)[1:] > reach[:-1]])
    return text[new], start[new], (reach - text * wide)[np.append(new[1:], True)]


_STAGE = "block long, kind int, bucket int, data binary"
_RECORDS, _SPANS, _ASKED = range(3)


def _row(block: int, kind: int, bucket: int, *arrays: np.ndarray) -> tuple:
    return block, kind, bucket, pack_arrays(*arrays)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    block, kind, bucket, data = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array(data, pa.binary())], ["block", "kind", "bucket", "data"])


def _by(key: np.ndarray):
    """Numbers of the rows of each key."""
    order = np.argsort(key, kind="stable")
    keys, first = np.unique(key[order], return_index=True)
    return zip(keys.tolist(), np.split(order, first[1:]), strict=True) if len(keys) else ()


def _first_of(digest: np.ndarray, check: np.ndarray) -> np.ndarray:
    """Of sorted digests, which are the first of their kind."""
    return np.concatenate([[True], (digest[1:] != digest[:-1]) | (check[1:] != check[:-1])]) if len(digest) else np.zeros(0, bool)


def _blocks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ordinal = 0
    for b in by_bytes(it, BLOCK_BYTES):
        if b.num_rows:
            ids, texts = b.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64), as_binary(b.column(1))
            flat = b"".join(texts)
            block, ordinal = block_number(ordinal, ids.tobytes(), flat), ordinal + 1
            data = pack_arrays(ids, np.array([len(t) for t in texts], np.uint32), np.frombuffer(flat, np.uint8))
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([data], pa.binary())], ["block", "data"])
            del texts, flat, data
            pa.default_memory_pool().release_unused()


def _scan(buckets: int, length: int, part: int, row: int):
    def scan(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each block, a row for each bucket of its records, and one with the spans that repeat within it."""
        for b in it:
            for block, data in zip(b.column("block").to_pylist(), b.column("data"), strict=True):
                own_ids, sizes, flat = unpack_arrays(data.as_py())
                ends = np.cumsum(sizes, dtype=np.int64)
                own = [flat[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                del flat
                r = block_records(own, length, part, row)
                rank = np.empty(len(own), np.int64)
                rank[np.argsort(own_ids, kind="stable")] = np.arange(len(own))
                order = np.lexsort((r["first"], rank[r["text"]], r["check"], r["digest"]))
                earliest = _first_of(r["digest"][order], r["check"][order])
                again = order[~earliest]
                rows = []
                if len(again):
                    rows.append(_row(block, _SPANS, block % buckets, *merged(r["text"][again], r["first"][again], r["last"][again] + length)))
                sent = np.sort(order[earliest])
                home = (r["fp"][sent] >> np.uint64(32)).astype(np.int64) % buckets
                for bucket, n in _by(home):
                    n = sent[n]
                    rows.append(
                        _row(block, _RECORDS, bucket, r["digest"][n], r["check"][n], r["fp"][n].astype(np.uint32), own_ids[r["text"][n]], r["text"][n].astype(np.uint32), r["first"][n].astype(np.uint32), (r["anchor"][n] - r["first"][n]).astype(np.uint8), (r["last"][n] - r["first"][n]).astype(np.uint8))
                    )
                yield _batch(rows)
                del rows, r, own
                pa.default_memory_pool().release_unused()

    return scan


def _compare(length: int, many: int):
    def compare(key: tuple, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records of one bucket: those whose digest is not the earliest are repeats; anchors with several digests need a closer look.
        Spans that the scan found pass through."""
        blocks, parts = [], []
        for b in it:
            of_scan = pc.equal(b.column("kind"), _SPANS)
            yield b.filter(of_scan).select(["block", "kind", "bucket", "data"])
            b = b.filter(pc.invert(of_scan))
            for block, data in zip(b.column("block").to_pylist(), b.column("data").to_pylist(), strict=True):
                parts.append(unpack_arrays(data))
                blocks.append(np.full(len(parts[-1][0]), block))
        if not parts:
            return
        block = np.concatenate(blocks)
        digest, check, fp, ids, text, first, anchor, more = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((text, block, first, ids, check, digest))
        earliest = _first_of(digest[order], check[order])
        again, one = order[~earliest], order[earliest]
        _, inverse, count = np.unique(fp[one], return_inverse=True, return_counts=True)
        asked = one[count[inverse] > 1]
        hot = (count[inverse] > many)[count[inverse] > 1].astype(np.uint8)
        rows = []
        for at, n in _by(block[again]):
            n = again[n]
            rows.append(_row(at, _SPANS, 0, *merged(text[n], first[n], first[n].astype(np.int64) + more[n] + length)))
        for at, n in _by(block[asked]):
            m = asked[n]
            rows.append(_row(at, _ASKED, key[0].as_py(), fp[m], text[m], first[m], more[m], hot[n]))
        yield _batch(rows)

    return compare


def _fetch(buckets: int, length: int):
    def fetch(left: pa.Table, right: pa.Table) -> pa.Table:
        """The bytes of the records that a block is asked for; strings of hot anchors one by one."""
        if right.num_rows and not left.num_rows:
            raise ValueError(CHANGED)
        rows = []
        for block, data in zip(*values(left, "block", "data"), strict=True):
            ids, sizes, flat = unpack_arrays(data)
            starts = np.cumsum(sizes, dtype=np.int64) - sizes
            singles = []
            for bucket, asked in zip(*values(right, "bucket", "data"), strict=True):
                _, text, first, more, hot = unpack_arrays(asked)
                text, first, more = text.astype(np.int64), first.astype(np.int64), more.astype(np.int64)
                cool = hot == 0
                if cool.any():
                    rows.append(_contexts(block, bucket, ids, starts, flat, text[cool], first[cool], more[cool] + length))
                if not cool.all():
                    count = more[~cool] + 1
                    singles.append((np.repeat(text[~cool], count), np.repeat(first[~cool], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)))
            if singles:
                text, first = (np.concatenate(x) for x in zip(*singles, strict=True))
                hashes = string_hashes(flat, starts[text] + first, length)
                order = np.lexsort((first, ids[text], hashes))
                earliest = np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]])
                _part_unequal(flat, (starts[text] + first)[order], earliest, length)
                again, one = order[~earliest], order[earliest]
                if len(again):
                    rows.append(_row(block, _SPANS, 0, *merged(text[again], first[again], first[again] + length)))
                for bucket, n in _by((hashes[one] >> np.uint64(32)).astype(np.int64) % buckets):
                    n = one[n]
                    rows.append(_contexts(block, buckets + bucket, ids, starts, flat, text[n], first[n], np.full(len(n), length)))
        return pa.Table.from_batches([_batch(rows)])

    return fetch


def _part_unequal(flat: np.ndarray, at: np.ndarray, earliest: np.ndarray, length: int) -> None:
    """Sets earliest also where a string's bytes differ from those of the one before, although their hashes agree."""
    alike = np.flatnonzero(~earliest)
    for k in range(0, len(alike), 1 << 14):
        n = alike[k : k + (1 << 14)]
        inside = np.arange(length)
        earliest[n[(flat[at[n][:, None] + inside] != flat[at[n - 1][:, None] + inside]).any(axis=1)]] = True


def _contexts(block: int, bucket: int, ids: np.ndarray, starts: np.ndarray, flat: np.ndarray, text: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple:
    at = np.repeat(starts[text] + first - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return _row(block, _ASKED, bucket, ids[text], text.astype(np.uint32), first.astype(np.uint32), size.astype(np.uint32), flat[at])


def _resolve(length: int, sort_bytes: int):
    def resolve(key: tuple, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, parts = [], []
        for b in it:
            for block, data in zip(b.column("block").to_pylist(), b.column("data").to_pylist(), strict=True):
                parts.append(unpack_arrays(data))
                blocks.append(np.full(len(parts[-1][0]), block))
        block = np.concatenate(blocks)
        ids, text, first, size, flat = (np.concatenate(x) for x in zip(*parts, strict=True))
        _, rank = np.unique(np.stack([ids, block, text.astype(np.int64)]), axis=1, return_inverse=True)
        of, start, end = find_repeats(flat, np.cumsum(size, dtype=np.int64), rank.ravel(), first.astype(np.int64), length, sort_bytes)
        rows = []
        for at, n in _by(block[of]):
            rows.append(_row(at, _SPANS, 0, *merged(text[of[n]], start[n], end[n])))
        yield _batch(rows)

    return resolve


def _finish(digest: bool):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] if digest else ["doc_id", "n_bytes", "spans", "kept"]

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        if right.num_rows and not left.num_rows:
            raise ValueError(CHANGED)
        columns: list[list] = [[] for _ in names]
        for data in values(left, "data")[0]:
            ids, sizes, flat = unpack_arrays(data)
            starts = np.cumsum(sizes, dtype=np.int64) - sizes
            spans = [unpack_arrays(x) for x in values(right, "span")[0]]
            text, start, end = merged(*(np.concatenate(x) for x in zip(*spans, strict=True))) if spans else [np.zeros(0, np.int64)] * 3
            cut = np.searchsorted(text, np.arange(len(ids) + 1))
            for i, (doc, size, at) in enumerate(zip(ids.tolist(), sizes.tolist(), starts.tolist(), strict=True)):
                own = list(zip(start[cut[i] : cut[i + 1]].tolist(), end[cut[i] : cut[i + 1]].tolist(), strict=True))
                edges = [0, *(x for s in own for x in s), size]
                kept = b"".join(flat[at + a : at + b].tobytes() for a, b in zip(edges[::2], edges[1::2], strict=True))
                found = (size, size - len(kept), len(own), hashlib.sha256(kept).hexdigest()) if digest else (size, [{"start": a, "end": b} for a, b in own], kept)
                for c, v in zip(columns, (None if doc == NO_ID else doc, *found), strict=True):
                    c.append(v)
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        types = [pa.int64()] * 4 + [pa.string()] if digest else [pa.int64(), pa.int64(), spans_type, pa.binary()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return finish


def remove_repeats(docs: DataFrame, length: int = LENGTH, part: int = PART, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, the removed spans and the kept bytes; with digest, n_removed, n_spans, kept_sha256.

    A byte goes if a string of `length` bytes that covers it also starts earlier: in a row with a smaller id, or before in the
    same text. Strings never cross texts and are judged on the input. A null text counts as empty. Null ids come before all
    others; rows that repeat an id come in the order of their blocks. Other columns are ignored. Equality rests on 128-bit
    digests where records agree as a whole, and on the bytes elsewhere (a hash alone drops nothing).
    """
    if not part < length <= part + 256:
        raise ValueError("the parts must be shorter than the strings, by 256 bytes at most")
    spark = docs.sparkSession
    buckets = 4 * shuffle_partitions(spark)
    # On disk alone: blocks kept in the heap leave no room for the tasks once the corpus is larger than the executors' memory.
    # Dealt out before they are kept, so that both cogroups find them in place and only what is small moves to them.
    whole = id_text(docs, id_col, text_col).mapInArrow(_blocks, "block long, data binary").repartition(shuffle_partitions(spark), "block").persist(StorageLevel.DISK_ONLY)
    with batch_bytes(spark, BLOCK_BYTES):
        whole.count()  # several branches read it: the texts are read once
        scanned = whole.mapInArrow(_scan(buckets, length, part, FLAT), _STAGE)
        compared = scanned.groupBy("bucket").applyInArrow(_compare(length, HOT), _STAGE).persist(StorageLevel.DISK_ONLY)
        compared.count()
    asked = compared.where(F.col("kind") == _ASKED).select("block", "bucket", "data")
    fetched = whole.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(_fetch(buckets, length), _STAGE).persist(StorageLevel.DISK_ONLY)
    fetched.count()
    resolved = fetched.where(F.col("kind") == _ASKED).select("bucket", "block", "data").groupBy("bucket").applyInArrow(_resolve(length, SORT_BYTES), _STAGE)
    spans = compared.unionByName(fetched).unionByName(resolved)
    # Under names of their own: the union has the columns of the scan, as has the other side of the cogroup.
    spans = spans.where(F.col("kind") == _SPANS).select(F.col("block").alias("of"), F.col("data").alias("span"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" if digest else "doc_id long, n_bytes long, spans array<struct<start: long, end: long>>, kept binary"
    return whole.groupBy("block").cogroup(spans.groupBy("of")).applyInArrow(_finish(digest), schema)
