"""Token-id files with keyed access.

Documents are encoded, dealt out by ranges of their ids, and written in ascending order as shards. A shard holds raw
ids (little-endian, two bytes where the vocabulary allows) and an index: a minimal perfect hash of the document keys
leads to a slot with a stored fingerprint, the offset and the length, so one document is read in constant time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import cuts
from .common import batch_bytes, by_bytes, id_text, mix64, shared_dir, shuffle_partitions, split_words, values, written
from .words import public_file, remembered, spread

SHARD_TOKENS, BATCH_WORDS, BATCH_BYTES = 200_000, 250_000, 4 << 20
#: Shards to read by key whose numbers are broadcast at most; beyond, shards and keys are joined by a shuffle.
BROADCAST_SHARDS = 100_000
NO_ID = -(2**63)
GAMMA, LEVELS = 2.0, 24


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: a cascade of bit arrays. A key's level is the first in which no
    other remaining key has its bit; its slot is the number of bits set before. Keys that share a bit in every level,
    if any, follow in a sorted list."""

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.ranks, total = [], 0
        for bits in levels:
            self.ranks.append(total + np.cumsum(bits) - bits)
            total += int(bits.sum())
        self.size = total + len(rest)

    @staticmethod
    def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys.astype(np.uint64)
        while len(left) and len(levels) < LEVELS:
            size = max(8, int(GAMMA * len(left)))
            at = cls._at(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[at]]
        return cls(levels, np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some keys that are not in the set, any slot for the others."""
        out, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        keys = keys.astype(np.uint64)
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = self._at(keys[open_], level, len(bits))
            hit = bits[at]
            out[open_[hit]] = rank[at[hit]]
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            out[open_[hit]] = self.size - len(self.rest) + at[hit]
        return out

    def dump(self) -> bytes:
        head = np.array([len(self.levels), *map(len, self.levels), len(self.rest)], "<u4").tobytes()
        return head + b"".join(np.packbits(x).tobytes() for x in self.levels) + self.rest.astype("<u8").tobytes()

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, "<u4", 1)[0])
        sizes, at, levels = np.frombuffer(data, "<u4", n + 1, 4).tolist(), 4 * (n + 2), []
        for size in sizes[:-1]:
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, (size + 7) // 8, at), count=size).astype(bool))
            at += (size + 7) // 8
        return cls(levels, np.frombuffer(data, "<u8", sizes[-1], at))


def keys_of(doc_ids: np.ndarray) -> np.ndarray:
    """A key for each of the sorted ids; rows that repeat an id are told apart by their ordinal."""
    first = np.concatenate([[True], doc_ids[1:] != doc_ids[:-1]]) if len(doc_ids) else np.zeros(0, bool)
    at = np.arange(len(doc_ids))
    ordinal = (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64)
    return mix64(doc_ids.astype(np.int64).view(np.uint64) + mix64(ordinal))


def _index(doc_ids: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    keys = keys_of(doc_ids)
    hashed = PerfectHash.of(keys)
    slots = hashed.slots(keys)
    rows = np.zeros(len(keys), [("fingerprint", "<u4"), ("offset", "<u8"), ("length", "<u4")])
    rows["fingerprint"][slots] = keys >> np.uint64(32)
    rows["offset"][slots], rows["length"][slots] = np.cumsum(lengths) - lengths, lengths
    return hashed.dump(), rows.tobytes()


def lookup(hash_data: bytes, slot_data: bytes, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each key is in the shard, and the offset and length of its ids."""
    rows = np.frombuffer(slot_data, [("fingerprint", "<u4"), ("offset", "<u8"), ("length", "<u4")])
    slots = PerfectHash.load(hash_data).slots(keys)
    found = (slots >= 0) & (slots < len(rows))
    found[found] = rows["fingerprint"][slots[found]] == (keys[found] >> np.uint64(32)).astype(np.uint32)
    at = np.where(found, slots, 0)
    return found, rows["offset"][at].astype(np.int64) if len(rows) else at, rows["length"][at].astype(np.int64) if len(rows) else at


_SHARD = "span int, shard int, first long, last long, start long, n_tokens long, width int, doc_ids binary, hash binary, slots binary, payload binary"


def _encoded(docs: DataFrame, path: str, end_id: int, cut_points: list[int]) -> DataFrame:
    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(it, BATCH_BYTES):
            span = np.searchsorted(cut_points, batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)).astype(np.int32)
            words, index, offsets = split_words(batch.column(1), lower=False)
            lower = pc.if_else(pc.match_substring(words, "<|"), words, pc.ascii_lower(words)).dictionary_encode()  # special tokens stay
            index = lower.indices.to_numpy(zero_copy_only=False)[index]
            flat, starts, lengths = remembered(path).encode(lower.dictionary, np.bincount(index, minlength=len(lower.dictionary)))
            wide = "<u2" if max(end_id, flat.max(initial=0)) < 1 << 16 else "<u4"
            flat = flat.astype(wide)
            for at, end in cuts(offsets, batch.num_rows, BATCH_WORDS):
                ids, ends = spread(index[offsets[at] : offsets[end]], flat, starts, lengths)
                cut = ends[offsets[at : end + 1] - offsets[at]]
                data, size = ids.tobytes(), ids.itemsize
                close = np.array([end_id], wide).tobytes()
                raw = [data[a * size : b * size] + close for a, b in zip(cut.tolist(), cut[1:].tolist(), strict=False)]
                piece = batch.slice(at, end - at)
                del ids
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(span[at:end]), pa.array([size] * piece.num_rows, pa.int32()), pa.array(raw, pa.binary())], ["doc_id", "span", "width", "ids"])

            del words, index, lower, flat, starts, lengths
            pa.default_memory_pool().release_unused()

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, span int, width int, ids binary")


def _shards(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by span and id become shards of SHARD_TOKENS ids or little more."""
    docs: list[tuple[int, int, bytes]] = []
    span, shard, start, held = None, 0, 0, 0

    def close() -> pa.RecordBatch:
        width = 2 if all(w == 2 for _, w, _ in docs) else 4
        parts = [x if w == width else np.frombuffer(x, "<u2").astype("<u4").tobytes() for _, w, x in docs]
        ids = np.array([d for d, _, _ in docs], "<i8")
        lengths = np.array([len(x) // width for x in parts], np.int64)
        hashed, slots = _index(ids, lengths)
        cells = [span, shard, int(ids[0]), int(ids[-1]), start, int(lengths.sum()), width, ids.tobytes(), hashed, slots, b"".join(parts)]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(cells, [pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.int32(), *[pa.binary()] * 4], strict=True)], [x.split()[0] for x in _SHARD.split(", ")])

    for b in it:
        for doc, s, width, ids in zip(b.column(0).fill_null(NO_ID).to_pylist(), *(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            if docs and (s != span or held >= SHARD_TOKENS and doc != docs[-1][0]):
                yield close()
                shard, start, docs = (shard + 1, start + held, []) if s == span else (0, 0, [])
                held = 0
            if s != span:
                span, shard, start = s, 0, 0
            docs.append((doc, width, ids))
            held += len(ids) // width
    if docs:
        yield close()


def write_shards(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 1, spans: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes docs and writes them to path in ascending order of their ids; end_id closes each document.

    tokenizer is the file of one that drops white space (word_bpe_49k by default): the distinct words of each batch are encoded once.
    A null text counts as empty and becomes the end id alone. Null ids come first. Rows that repeat an id are kept, in
    any order among themselves. Other columns are ignored. An empty table gives an empty set of shards.
    """
    spans = spans or shuffle_partitions(docs.sparkSession)
    thin = id_text(docs, id_col, text_col)
    cut_points = thin.agg(F.percentile_approx("doc_id", [i / spans for i in range(1, spans)] or [0.5], 10000)).first()[0] or []
    encoded = _encoded(thin, tokenizer or public_file("word_bpe_49k.json"), end_id, sorted(set(cut_points)) if spans > 1 else [])
    placed = encoded.repartition(spans, "span").sortWithinPartitions("span", F.col("doc_id").asc_nulls_first())
    with batch_bytes(docs.sparkSession, BATCH_BYTES):
        placed.mapInArrow(_shards, _SHARD).write.option("parquet.block.size", 16 << 20).parquet(path)


def read_documents(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Every document of the shards at path, looked up through their indexes: doc_id, start, n_tokens and the ids (or their CRC-32)."""

    def read(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at in range(b.num_rows):
                (row,) = b.slice(at, 1).to_pylist()  # one shard at a time
                doc_ids = np.frombuffer(row["doc_ids"], "<i8")
                found, offset, length = lookup(row["hash"], row["slots"], keys_of(doc_ids))
                if not found.all():
                    raise ValueError(f"span {row['span']}, shard {row['shard']}: the index does not know all documents")
                ids = np.frombuffer(row["payload"], f"<u{row['width']}").astype("<u4")
                parts = [ids[a : a + n] for a, n in zip(offset, length, strict=True)]
                last = pa.array([zlib.crc32(x.tobytes()) for x in parts], pa.int64()) if digest else pa.array([x.tolist() for x in parts], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, mask=doc_ids == NO_ID), pa.array([row["span"]] * len(parts), pa.int32()), pa.array(offset + row["start"]), pa.array(length), last], ["doc_id", "span", "start", "n_tokens", "last"])

    shards = spark.read.schema(_SHARD).parquet(path)
    totals = shards.groupBy("span").agg(F.sum("n_tokens").alias("n")).orderBy("span").collect()  # a row for each span, not for each document
    before, base = 0, []
    for row in totals:
        base.append((row["span"], before))
        before += row["n"]
    bases = spark.createDataFrame(base, "span int, base long")
    last = "ids_crc32" if digest else "ids"
    docs = shards.mapInArrow(read, f"doc_id long, span int, start long, n_tokens long, last {'long' if digest else 'array<long>'}")
    return docs.join(F.broadcast(bases), "span").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", F.col("last").alias(last))


def read_keys(spark: SparkSession, path: str, keys: DataFrame, id_col: str = "doc_id", broadcast_shards: int = BROADCAST_SHARDS) -> DataFrame:
    """The ids of the documents that keys asks for: doc_id, ids. Keys that no shard holds give no row, and neither do null keys
    or repeats of a key; of rows that repeat an id, all are found.

    Keys find their span and shard by the shards' first and last ids. Only the shards that hold one are opened, where they are scanned;
    if they are more than broadcast_shards, they are joined by a shuffle instead. In a shard the index leads to the ids.
    """
    shards = spark.read.schema(_SHARD).parquet(path)
    known = shards.select("span", "shard", "first", "last")
    spans = known.groupBy("span").agg(F.min("first").alias("first")).orderBy("span").collect()  # a row for each span
    starts, numbers = np.array([r["first"] for r in spans], np.int64), np.array([r["span"] for r in spans], np.int32)

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = np.searchsorted(starts, ids, "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(numbers[at[at >= 0]]), pa.array(ids[at >= 0])], ["span", "doc_id"])

    def in_span(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, first, last, shard = (np.array(x, np.int64) for x in (*values(left, "doc_id"), *values(right, "first", "last", "shard")))
        order, ids = np.argsort(first), np.sort(ids)
        at = np.searchsorted(first[order], ids, "right") - 1
        inside = (at >= 0) & (ids <= last[order][np.maximum(at, 0)]) if len(order) else np.zeros(len(ids), bool)
        chosen, cut = np.unique(order[at[inside]], return_index=True)
        wanted = np.split(ids[inside], np.sort(cut)[1:]) if len(chosen) else []
        chosen = order[at[inside]][np.sort(cut)] if len(chosen) else chosen
        return pa.Table.from_arrays([pa.array([right.column("span")[0].as_py()] * len(chosen), pa.int32()), pa.array(shard[chosen], pa.int32()), pa.array([x.tolist() for x in wanted], pa.list_(pa.int64()))], ["span", "shard", "wanted"])

    def fetch(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at in range(b.num_rows):
                (row,) = b.slice(at, 1).to_pylist()  # one shard at a time
                own, wanted = np.frombuffer(row["doc_ids"], "<i8"), np.array(row["wanted"], np.int64)
                times = np.searchsorted(own, wanted, "right") - np.searchsorted(own, wanted)  # no other document has a key by chance
                asked = np.repeat(wanted, times)
                found, offset, length = lookup(row["hash"], row["slots"], keys_of(asked))
                if not found.all():
                    raise ValueError(f"span {row['span']}, shard {row['shard']}: the index does not know all documents")
                ids = np.frombuffer(row["payload"], f"<u{row['width']}")
                yield pa.RecordBatch.from_arrays([pa.array(asked), pa.array([ids[a : a + n].tolist() for a, n in zip(offset, length, strict=True)], pa.list_(pa.int64()))], ["doc_id", "ids"])

    asked = keys.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct().mapInArrow(place, "span int, doc_id long")
    wanted = written(asked.groupBy("span").cogroup(known.groupBy("span")).applyInArrow(in_span, "span int, shard int, wanted array<long>"), "wanted-shards")
    size = wanted.agg(F.count(F.lit(1)).alias("shards"), F.sum(F.size("wanted")).alias("keys")).first()
    few = size["shards"] <= broadcast_shards and (size["keys"] or 0) <= 10 * broadcast_shards
    chosen = shards.select("span", "shard", "width", "doc_ids", "hash", "slots", "payload").join(F.broadcast(wanted) if few else wanted, ["span", "shard"])
    return chosen.mapInArrow(fetch, "doc_id long, ids array<long>")


def token_files(docs: DataFrame) -> DataFrame:
    """Writes docs as shards in the shared folder and returns what is read back from them: doc_id, start, n_tokens, ids_crc32."""
    import uuid

    path = f"{shared_dir(docs.sparkSession)}/token-files-{uuid.uuid4().hex}"
    write_shards(docs, path)
    return read_documents(docs.sparkSession, path, digest=True)
