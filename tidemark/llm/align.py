"""Alignment of two tokenizers' tokens by the bytes they cover.

1. A text with a space before it is cut into units where both tokenizers start afresh; each distinct unit of a batch is
   encoded once. Where tokens of both end at one byte, a group closes.
2. Texts of more than `piece` bytes are cut into byte ranges, which tasks encode apart. The tokenizers can be cut at different
   places, so a range gives a fragment: tokens before the first common end (open prefix), closed groups, and tokens after the
   last common end (open suffix). Fragments form a monoid under composition, which aligns one's suffix with the next one's
   prefix, and a tree of Spark tasks reduces those of a text to one.
3. Every block of documents counts in how many of its documents an id pair is linked; the counts are added up for the corpus,
   each A id's highest is found, and both come back to the block that sent the pair.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import pieces
from .common import by_bytes, id_text, pack_arrays, unpack_arrays, written
from .words import public_file

PIECE, BATCH_BYTES, FAN = 1 << 16, 2 << 20, 16
#: Units that a worker remembers, and that it hands to a library at once.
MOST_KEPT, UNITS = 100_000, 8192
NO_ID = -(2**63)


# --- tokens of units ---


@dataclass(frozen=True)
class Pair:
    """The files of tokenizer A (byte-level BPE) and B (sentencepiece with byte fallback)."""

    a: str
    b: str


def public_pair() -> Pair:
    return Pair(public_file("byte_bpe_50k.json"), public_file("piece_bpe_32k.model"))


def _encoder_a(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    t.encode_special_tokens = True  # their strings in a text are ordinary text
    return lambda units: [e.ids for e in t.encode_batch_fast(units, add_special_tokens=False)]


@lru_cache(maxsize=2)
def _model_b(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _pieces_b(path: str) -> list[bytes]:
    sp = _model_b(path)
    return [bytes([int(p[1:-1], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(map(sp.id_to_piece, range(sp.get_piece_size())))]


class Side:
    """One tokenizer in a worker: the bytes of its tokens, and the ids of units, of which it remembers repeated ones."""

    def __init__(self, encode, tokens: list[bytes]):
        self.encode = encode
        self.tokens = pa.array(tokens, pa.binary())
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.decimal = pa.array(map(str, range(len(tokens))), pa.string())
        self.place: dict[str, int] = {}
        self.ids, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def of(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units in a row, and how many each has."""
        coded = units.dictionary_encode()
        index, distinct = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
        place = np.fromiter(map(self.place.get, distinct, repeat(-1)), np.int64, len(distinct))
        fresh = np.flatnonzero(place < 0)
        fresh = fresh[np.argsort(np.bincount(index, minlength=len(distinct))[fresh] < 2, kind="stable")]  # repeated ones first
        ids, lengths = [self.ids], [np.zeros(0, np.int64)]
        for at in range(0, len(fresh), UNITS):
            got = self.encode([distinct[i] for i in fresh[at : at + UNITS]])
            lengths.append(np.fromiter(map(len, got), np.int64, len(got)))
            ids.append(np.fromiter((x for g in got for x in g), np.int64, int(lengths[-1].sum())))
        ids, lengths = np.concatenate(ids), np.concatenate(lengths)
        place[fresh] = len(self.lengths) + np.arange(len(fresh))
        keep = min(len(fresh), MOST_KEPT - len(self.place))
        lengths = np.concatenate([self.lengths, lengths])
        self.place.update(zip([distinct[i] for i in fresh[:keep]], range(len(self.place), len(self.place) + keep), strict=True))
        self.lengths = lengths[: len(self.place)].copy()
        self.ids = ids[: self.lengths.sum()].copy()
        place, starts = place[index], np.cumsum(lengths) - lengths
        n = lengths[place]
        ends = np.cumsum(n)
        return ids[np.repeat(starts[place] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)], n

    def tell(self, ids: np.ndarray, texts: np.ndarray, starts: np.ndarray, ends: np.ndarray, token_ends: np.ndarray) -> np.ndarray:
        """For each text (bytes start to end of texts) whether its tokens, up to token_ends, have just these bytes."""
        size = np.concatenate([[0], np.cumsum(self.size[ids])])[np.concatenate([[0], token_ends])]
        same = np.diff(size) == ends - starts
        joined = np.frombuffer(self.tokens.take(pa.array(ids)).buffers()[2] or b"", np.uint8, int(size[-1])) if size[-1] else np.zeros(0, np.uint8)
        if same.all() and len(joined) == len(texts) and (joined == texts).all():
            return same
        for i in np.flatnonzero(same):
            same[i] = (joined[size[i] : size[i + 1]] == texts[starts[i] : ends[i]]).all()
        return same


@lru_cache(maxsize=2)
def sides(pair: Pair) -> tuple[Side, Side]:
    b = _model_b(pair.b)
    last = [b.piece_to_id("▁")]  # a text's last space; alone it would be an empty text to the library

    def encode_b(units: list[str]) -> list[list[int]]:
        """The library puts a space before every text, and every unit begins with one."""
        return [ids or last for ids in b.encode([u[1:] for u in units], num_threads=1)]

    return Side(_encoder_a(pair.a), pieces(pair.a)), Side(encode_b, _pieces_b(pair.b))


def safe_cuts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the bytes of a text may be cut so that either tokenizer gives the same tokens: for A, for B.

    Both start afresh at a space after what is no white space; A also at a punctuation mark or line end after a letter.
    """
    before, two, three = (np.concatenate([np.zeros(k, np.uint8), data[:-k]]) if len(data) > k else np.zeros(len(data), np.uint8) for k in (1, 2, 3))
    maybe_blank = (two == 0xC2) | ((three == 0xE1) & (two == 0x9A)) | ((three == 0xE2) & ((two == 0x80) | (two == 0x81))) | ((three == 0xE3) & (two == 0x80))
    solid = ((before > 0x20) & (before < 0x7F)) | ((before >= 0x80) & ~maybe_blank)
    b = (data == 0x20) & solid
    letter = ((before | 0x20) >= 0x61) & ((before | 0x20) <= 0x7A)
    return b | (letter & np.isin(data, np.frombuffer(b",.;:!?\n", np.uint8))), b


def _units(data: np.ndarray, cut: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The units of texts that begin at starts, and of each text the number of units up to its end."""
    cut = cut.copy()
    cut[starts] = True
    at = np.concatenate([np.flatnonzero(cut), [len(data)]]).astype(np.int32)
    units = pa.Array.from_buffers(pa.string(), len(at) - 1, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(data)])
    return units, np.searchsorted(at[:-1], np.concatenate([starts[1:], [len(data)]]))


def encode(text: pa.Array, pair: Pair) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids of A and B for texts that begin with a space, and per side the number of ids up to each text's end. A text that
    is only the space, or whose tokens of either side do not spell it, has none."""
    text = text.cast(pa.string())
    bounds = np.frombuffer(text.buffers()[1], np.int32, len(text) + 1, text.offset * 4).astype(np.int64)
    data = np.frombuffer(text.buffers()[2], np.uint8, bounds[-1] - bounds[0], int(bounds[0])) if len(text) else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0] if len(bounds) else np.zeros(1, np.int64)
    ids, ends, good = [], [], np.diff(bounds) > 1
    for side, cut in zip(sides(pair), safe_cuts(data), strict=True):
        units, last = _units(data, cut, bounds[:-1])
        got, n = side.of(units)
        end = np.concatenate([[0], np.cumsum(n)])[last]
        good &= side.tell(got, data, bounds[:-1], bounds[1:], end)
        ids.append(got)
        ends.append(end)
    if not good.all():
        for k in range(2):
            size = np.diff(ends[k], prepend=0)
            ids[k], ends[k] = ids[k][np.repeat(good, size)], np.cumsum(size * good)
    return ids, ends


# --- groups and fragments ---


def closings(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of A and of B lie before each common end, from the ascending byte ends of the tokens."""
    if not len(ends_a) or not len(ends_b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(ends_b, ends_a)
    common = ends_b[np.minimum(at, len(ends_b) - 1)] == ends_a
    return np.flatnonzero(common) + 1, at[common] + 1


@dataclass
class Fragment:
    """The tokens of a byte range. left: ids of A and B before the first common end; groups: ids of A and B that are closed, and the
    sizes of the groups; right: ids after the last common end. start: the bytes at which A's and B's tokens begin."""

    start: np.ndarray
    left: tuple[np.ndarray, np.ndarray]
    groups: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    right: tuple[np.ndarray, np.ndarray]
    closed: bool = False
    good: bool = True

    def pack(self) -> bytes:
        return pack_arrays(self.start, np.array([self.closed, self.good], np.int64), *self.left, *self.groups, *self.right)

    @staticmethod
    def unpack(data: bytes) -> Fragment:
        start, flags, *x = unpack_arrays(data)
        return Fragment(start, (x[0], x[1]), tuple(x[2:6]), (x[6], x[7]), bool(flags[0]), bool(flags[1]))


_NONE = np.zeros(0, np.int64)


def fragment(ids: tuple[np.ndarray, np.ndarray], start: np.ndarray, size: tuple[np.ndarray, np.ndarray], good: bool = True) -> Fragment:
    """Of the tokens of a byte range; start: where A's and B's begin, size: the bytes of each id of A and B."""
    a, b = closings(start[0] + np.cumsum(size[0][ids[0]]), start[1] + np.cumsum(size[1][ids[1]]))
    if not len(a):
        return Fragment(start, ids, (_NONE,) * 4, (_NONE, _NONE), False, good)
    cut = lambda x, n: (x[: n[0]], x[n[0] : n[-1]], x[n[-1] :])
    (la, ga, ra), (lb, gb, rb) = cut(ids[0], a), cut(ids[1], b)
    return Fragment(start, (la, lb), (ga, gb, np.diff(a), np.diff(b)), (ra, rb), True, good)


def compose(f: Fragment, g: Fragment, size: tuple[np.ndarray, np.ndarray]) -> Fragment:
    """The fragment of two byte ranges in a row. Associative."""
    open_f = f.right if f.closed else f.left
    middle = tuple(np.concatenate([x, y]) for x, y in zip(open_f, g.left, strict=True))
    start = f.start + [sum(int(size[k][x].sum()) for x in (f.left[k], f.groups[k])) for k in range(2)] if f.closed else f.start
    m = fragment(middle, start, size)
    join = lambda *gs: tuple(np.concatenate(x) for x in zip(*gs, strict=True))
    right = g.right if g.closed else m.right
    if f.closed:  # the middle begins at a common end, so its left is one whole group
        first = (*m.left, *(np.array([len(x)]) for x in m.left)) if m.closed else (_NONE,) * 4
        return Fragment(f.start, f.left, join(f.groups, first, m.groups, g.groups), right if m.closed or g.closed else m.left, True, f.good and g.good)
    return Fragment(f.start, m.left, join(m.groups, g.groups), right, m.closed, f.good and g.good)


def finished(f: Fragment) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of A and B and sizes of the groups of a whole text: what lies before its first common end is a group."""
    if not f.good or not f.closed or len(f.right[0]) or len(f.right[1]):
        return (_NONE,) * 4
    return tuple(np.concatenate([x, y]) for x, y in zip((*f.left, *(np.array([len(x)]) for x in f.left)), f.groups, strict=True))


def _first_cut(cut: np.ndarray, at: int) -> int:
    """The first cut from a byte on, or the end."""
    step = 4096
    while at < len(cut):
        found = np.flatnonzero(cut[at : at + step])
        if len(found):
            return at + int(found[0])
        at += step
    return len(cut)


def _pieces(docs: DataFrame, piece: int) -> DataFrame:
    """Byte ranges of long texts: doc_id, row (which text), nth, where A's and B's parts begin, and the two parts."""

    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for id_, text in zip(b.column(0), b.column(1), strict=True):
                raw = b" " + text.as_py().encode()
                row, data = int.from_bytes(os.urandom(8), "little", signed=True), np.frombuffer(raw, np.uint8)
                marks = range(piece, len(raw), piece)
                edges = [[0, *(_first_cut(cut, m) for m in marks), len(raw)] for cut in safe_cuts(data)]
                for nth in range(len(marks) + 1):
                    (a, a_end), (c, c_end) = (e[nth : nth + 2] for e in edges)
                    yield pa.RecordBatch.from_pylist(
                        [{"doc_id": id_.as_py(), "row": row, "nth": nth, "a": a, "b": c, "text_a": raw[a:a_end].decode(), "text_b": raw[c:c_end].decode()}],
                        pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("nth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("text_a", pa.string()), ("text_b", pa.string())]),
                    )

    return docs.mapInArrow(of, "doc_id long, row long, nth long, a long, b long, text_a string, text_b string")


def _fragments(ranges: DataFrame, pair: Pair) -> DataFrame:
    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sides(pair)
        for b in it:
            out = []
            for r in b.to_pylist():
                ids, good = [], True
                for side, k, text in zip(both, (0, 1), (r["text_a"], r["text_b"]), strict=True):
                    data = np.frombuffer(text.encode(), np.uint8)
                    if len(data):
                        got, _ = side.of(_units(data, safe_cuts(data)[k], np.zeros(1, np.int64))[0])
                        good &= bool(side.tell(got, data, np.zeros(1, np.int64), np.array([len(data)]), np.array([len(got)]))[0])
                    ids.append(got if len(data) else _NONE)
                out.append(fragment(tuple(ids), np.array([r["a"], r["b"]]), (both[0].size, both[1].size), good).pack())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("row"), b.column("nth"), pa.array(out, pa.binary())], ["doc_id", "row", "nth", "data"])

    return ranges.mapInArrow(of, "doc_id long, row long, nth long, data binary")


def _reduced(fragments: DataFrame, pair: Pair, fan: int) -> DataFrame:
    """Up to `fan` fragments in a row of each text become one."""

    def of(key: tuple, rows: pa.Table) -> pa.Table:
        size = tuple(s.size for s in sides(pair))
        order = np.argsort(rows.column("nth").to_numpy())
        data = rows.column("data")
        whole = Fragment.unpack(data[int(order[0])].as_py())
        for i in order[1:].tolist():
            whole = compose(whole, Fragment.unpack(data[i].as_py()), size)
        return pa.table({"doc_id": rows.column("doc_id").slice(0, 1), "row": pa.array([key[0].as_py()], pa.int64()), "nth": pa.array([key[1].as_py()], pa.int64()), "data": pa.array([whole.pack()], pa.binary())})

    return fragments.groupBy("row", F.floor(F.col("nth") / fan).alias("up")).applyInArrow(of, "doc_id long, row long, nth long, data binary")


# --- blocks of documents and corpus counts ---


def _block(doc_ids: list, a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray, close_a: np.ndarray, close_b: np.ndarray, pair: Pair, digest: bool) -> pa.RecordBatch:
    """A row with all about a block's documents but the corpus's counts, and a row for each of its id pairs.

    ends: tokens up to each document's end; close: tokens up to each group's end.
    """
    side_a, side_b = sides(pair)
    byte_a, byte_b = np.cumsum(side_a.size[a]), np.cumsum(side_b.size[b])
    groups = np.searchsorted(close_a, ends_a, "right")  # up to each document's end
    bounds = np.union1d(byte_a, byte_b)  # a link is a stretch of bytes in one token of each
    at_a, at_b = np.searchsorted(byte_a, bounds), np.searchsorted(byte_b, bounds)
    links, kind = np.unique(a[at_a] << 32 | b[at_b], return_inverse=True)
    doc = np.searchsorted(ends_a, at_a, "right")
    own, times = np.unique(doc * max(len(links), 1) + kind, return_counts=True)
    own_doc, own_kind = own // max(len(links), 1), own % max(len(links), 1)
    n_docs = np.bincount(own_kind, minlength=len(links))
    n = len(doc_ids)
    size = lambda ends: np.diff(ends, prepend=0)
    if digest:
        text = lambda side, ids, close: pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], close]).astype(np.int32)), side.decimal.take(pa.array(ids))), ",")
        each = pc.binary_join_element_wise(text(side_a, a, close_a), text(side_b, b, close_b), "|")
        whole = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], groups]).astype(np.int32)), each), ";")
        more = [np.frombuffer(b"".join(hashlib.sha256(t.as_buffer()).digest() for t in whole.cast(pa.binary())), np.uint8)]
    else:
        more = [a, b, np.diff(close_a, prepend=0), np.diff(close_b, prepend=0)]
    id_ = np.array([NO_ID if i is None else i for i in doc_ids], np.int64)
    data = pack_arrays(id_, size(ends_a), size(ends_b), size(groups), np.bincount(doc, minlength=n), np.searchsorted(own_doc, np.arange(n + 1)), own_kind.astype(np.uint32), times.astype(np.uint32), *more)
    block = int.from_bytes(os.urandom(8), "little", signed=True)  # what is committed of a task is read from a table
    none = [None] * len(links)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block] * (len(links) + 1), pa.int64()),
            pa.array([None, *range(len(links))], pa.int32()),
            pa.array([None, *links.tolist()], pa.int64()),
            pa.array([None, *n_docs.tolist()], pa.int64()),
            pa.array([data, *none], pa.binary()),
        ],
        ["block", "kind", "pair", "n", "data"],
    )


_BLOCK = "block long, kind int, pair long, n long, data binary"


def _blocks(docs: DataFrame, pair: Pair, digest: bool) -> DataFrame:
    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = [s.size for s in sides(pair)]
        for b in by_bytes(it, BATCH_BYTES):
            (x, y), (ends_x, ends_y) = encode(pc.binary_join_element_wise("", b.column(1), " "), pair)
            yield _block(b.column(0).to_pylist(), x, ends_x, y, ends_y, *closings(np.cumsum(size[0][x]), np.cumsum(size[1][y])), pair, digest)
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(of, _BLOCK)


def _long_blocks(reduced: DataFrame, pair: Pair, digest: bool) -> DataFrame:
    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for id_, data in zip(b.column("doc_id").to_pylist(), b.column("data"), strict=True):
                x, y, n_x, n_y = finished(Fragment.unpack(data.as_py()))
                yield _block([id_], x, np.array([len(x)]), y, np.array([len(y)]), np.cumsum(n_x), np.cumsum(n_y), pair, digest)

    return reduced.select("doc_id", "data").mapInArrow(of, _BLOCK)


def _documents(blocks: DataFrame, digest: bool) -> DataFrame:
    """The documents of blocks (data, known: kind, count and best of every pair)."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256" if digest else "groups"]

    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for i in range(b.num_rows):
                id_, n_a, n_b, n_groups, n_links, ends, kind, times, *more = unpack_arrays(b.column("data")[i].as_py())
                known = b.column("known")[i].values
                count, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if known is not None and len(known):
                    order = np.argsort(known.field("kind").to_numpy())
                    count, best = (known.field(c).to_numpy(zero_copy_only=False).astype(np.int64)[order] for c in ("count", "best"))
                upto = lambda x: np.concatenate([[0], np.cumsum(x)])[ends]  # noqa: E731, B023
                n_best, count_sum = (np.diff(upto(x[kind] * times.astype(np.int64))) for x in (best, count))
                if digest:
                    last = pa.array([more[0][32 * k : 32 * k + 32].tobytes().hex() if n else "" for k, n in enumerate(n_a)], pa.string())
                else:
                    lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(x)) for x, n in zip(more[:2], more[2:], strict=True)]
                    last = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_groups)]).astype(np.int32)), pa.StructArray.from_arrays(lists, ["a", "b"]))
                ids = pa.array(id_, mask=id_ == NO_ID)
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(x.astype(np.int64)) for x in (n_a, n_b, n_groups, n_links, n_best, count_sum)), last], names)

    kind = "groups_sha256 string" if digest else "groups array<struct<a: array<long>, b: array<long>>>"
    return blocks.mapInArrow(of, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, " + kind)


def align(docs: DataFrame, pair: Pair | None = None, piece: int = PIECE, fan: int = FAN, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (a, b: the ids of each group).

    A encodes the text with a space before it, B the text, before which it puts a space itself; special tokens are never added nor
    recognised. Groups end where tokens of both end; a link is a pair of tokens with a byte in common. A pair of ids counts
    as many documents as have it linked; n_best is the number of links whose count no pair of their A id exceeds, count_sum the sum
    over links. With digest, groups_sha256 in place of groups: SHA-256 of `a1,a2|b1;a3|b2,b3`, '' without tokens.

    Texts that are null or empty, or that either tokenizer does not spell (it changes or loses bytes), have no tokens: zeros.
    Rows that repeat an id are documents of their own and count each; a null id stays null. Other columns are ignored; an empty
    table gives an empty result. The groups of one text must fit in a row.
    """
    pair = pair or public_pair()
    docs = id_text(docs, id_col, text_col)
    long = F.octet_length("text") > piece
    ranges = written(_pieces(docs.where(long), piece), "ranges", BATCH_BYTES)
    fragments = written(_fragments(ranges.repartition("row", "nth"), pair), "fragments", BATCH_BYTES)
    left = (fragments.agg(F.max("nth")).first()[0] or 0) + 1  # one number
    while left > 1:
        fragments, left = written(_reduced(fragments, pair, fan), "fragments", BATCH_BYTES), -(-left // fan)
    blocks = _blocks(docs.where(~long), pair, digest).union(_long_blocks(fragments, pair, digest))
    blocks = written(blocks, "aligned")
    pairs = blocks.where("pair IS NOT NULL").select("block", "kind", "pair", "n")
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a", F.shiftright("pair", 32))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    counts = counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    known = pairs.join(counts, "pair").groupBy("block").agg(F.collect_list(F.struct("kind", "count", "best")).alias("known"))  # a block's own pairs
    whole = blocks.where("pair IS NULL").select("block", "data").join(known, "block", "left").select("data", "known")
    return written(_documents(whole, digest), "alignment", BATCH_BYTES)
