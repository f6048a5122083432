"""BPE encoding and decoding through a table of distinct words.

1. Spark splits every text into words. A task numbers the distinct words of each block of documents and keeps the
   documents as rows of those numbers.
2. The blocks' distinct words meet by hash; there each distinct word of the corpus is encoded once, and every block
   that has it gets the ids back.
3. Each block joins the ids back by position, and decodes them through the table of pieces (fixed by the vocabulary).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import NO_ID, block_number, cuts, from_planes, number, pack, planes, unpack
from .common import CHANGED, id_text, shuffle_partitions, values
from .words import Vocabulary, byte_bpe, encode_words, spread, tokenizer

_BLOCKS = "block long, part int, data binary, ids binary, counts binary, home binary"


def _blocks(docs: DataFrame, vocabulary: Vocabulary, parts: int) -> DataFrame:
    """Two kinds of rows: the distinct words of a block whose hash is `part`, and, with part null, the block's documents."""

    def build(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinal = 0
        for batch in it:
            offsets = batch.column(1).offsets.to_numpy().astype(np.int64)
            for at, end in cuts(offsets, batch.num_rows):
                piece = batch.slice(at, end - at)
                counts = np.diff(offsets[at : end + 1])
                flat = piece.column(1).flatten().dictionary_encode()
                index, words = flat.indices.to_numpy(zero_copy_only=False), flat.dictionary.cast(pa.binary()).to_pylist()
                rank, home, by_part = number(words, index, parts)
                at_rank = [words[i] for i in np.argsort(rank)]
                rows = [(p, pack([at_rank[i] for i in own])) for p, own in by_part]
                ids, data = piece.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes(), planes(rank[index])
                block, ordinal = block_number(ordinal, ids, data, *(d for _, d in rows)), ordinal + 1
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": [block] * (len(rows) + 1),
                        "part": [None, *(p for p, _ in rows)],
                        "data": [data, *(d for _, d in rows)],
                        "ids": [ids, *[None] * len(rows)],
                        "counts": [counts.astype("<u4").tobytes(), *[None] * len(rows)],
                        "home": [planes(home), *[None] * len(rows)],
                    },
                    pa.schema([("block", pa.int64()), ("part", pa.int32()), ("data", pa.binary()), ("ids", pa.binary()), ("counts", pa.binary()), ("home", pa.binary())]),
                )

    return docs.select("doc_id", vocabulary.words(F.col("text")).alias("words")).mapInArrow(build, _BLOCKS)


def _encode(vocabulary: Vocabulary):
    path = vocabulary.path

    def encode(key: tuple, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every distinct word of the part once, then each block's share of the ids."""
        asked: list[tuple[int, bytes]] = []
        ids: dict[bytes, bytes] = {}
        for b in it:
            for block, data in zip(b.column("block").to_pylist(), b.column("data").to_pylist(), strict=True):
                asked.append((block, data))
                fresh = [w for w in unpack(data) if w not in ids]
                ids.update(zip(fresh, encode_words(path, [w.decode() for w in fresh]), strict=True))
        for block, data in asked:
            got = [ids[w] for w in unpack(data)]
            lengths = np.fromiter((len(x) // 4 for x in got), np.uint32, len(got))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([key[0].as_py()], pa.int32()), pa.array([planes(lengths)], pa.binary()), pa.array([planes(np.frombuffer(b"".join(got), "<u4"))], pa.binary())],
                ["block", "part", "lengths", "pieces"],
            )

    return encode


@lru_cache(maxsize=4)
def pieces(path: str) -> list[bytes]:
    """The bytes of each id: the table that decoding joins with. Its size is the vocabulary's."""
    t = tokenizer(path)
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the rest follow from 256 on
    byte = {chr(b): b for b in keep} | {chr(256 + n): b for n, b in enumerate(x for x in range(256) if x not in set(keep))}
    out = [b""] * t.get_vocab_size()
    for piece, at in t.get_vocab().items():
        out[at] = bytes(byte[c] for c in piece)
    return out


def _decoded(path: str, digest: bool):
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digest else ["doc_id", "ids", "decoded"]

    def decode(left: pa.Table, right: pa.Table) -> pa.Table:
        if right.num_rows and not left.num_rows:
            raise ValueError(CHANGED)
        columns: list[list] = [[] for _ in names]
        for at in range(left.num_rows):
            row = {c: left.column(c)[at].as_py() for c in ("data", "ids", "counts", "home")}
            home = from_planes(row["home"])
            starts, lengths, flat, done = np.zeros(len(home), np.int64), np.zeros(len(home), np.int64), [], 0
            for part, n, ids in zip(*values(right, "part", "lengths", "pieces"), strict=True):
                n, ids = from_planes(n).astype(np.int64), from_planes(ids)
                mine = home == part
                lengths[mine], starts[mine] = n, done + np.cumsum(n) - n
                flat.append(ids)
                done += len(ids)
            if len(home) and not lengths.all():
                raise ValueError(CHANGED)
            flat = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
            index = from_planes(row["data"])
            ends = np.cumsum(np.concatenate([[0], np.frombuffer(row["counts"], "<u4")]), dtype=np.int64)
            table = pieces(path)
            for doc, a, b in zip(np.frombuffer(row["ids"], "<i8").tolist(), ends, ends[1:], strict=False):
                ids, _ = spread(index[a:b], flat, starts, lengths)
                text = b"".join(map(table.__getitem__, ids.tolist())).decode("utf-8", "replace")
                raw = ids.astype("<u4").tobytes()
                found = (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest()) if digest else (ids.tolist(), text)
                for c, v in zip(columns, (None if doc == NO_ID else doc, *found), strict=True):
                    c.append(v)
        types = [pa.int64(), pa.int64(), pa.string(), pa.string()] if digest else [pa.int64(), pa.list_(pa.int64()), pa.string()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return decode


def round_trip(docs: DataFrame, vocabulary: Vocabulary | None = None, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, ids and decoded text; with digest, n_tokens and SHA-256 digests of the two instead.

    Ids are those of the tokenizers library without added special tokens, decoded with skip_special_tokens=False. A null
    text counts as empty and has no ids; a null id stays null; rows that repeat are encoded alike. Other columns are ignored.
    """
    vocabulary = vocabulary or byte_bpe()
    blocks = _blocks(id_text(docs, id_col, text_col), vocabulary, shuffle_partitions(docs.sparkSession)).persist(StorageLevel.MEMORY_AND_DISK)
    blocks.count()  # two branches read it: the split runs once
    words = blocks.where("part IS NOT NULL").select("part", "block", "data")
    table = words.groupBy("part").applyInArrow(_encode(vocabulary), "block long, part int, lengths binary, pieces binary")
    whole = blocks.where("part IS NULL").select("block", "data", "ids", "counts", "home")
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "doc_id long, ids array<long>, decoded string"
    return whole.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(_decoded(vocabulary.path, digest), schema)
