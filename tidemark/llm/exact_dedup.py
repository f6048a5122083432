"""Exact duplicates by counting quotient filters.

Every task builds a counting quotient filter of its documents' 64-bit fingerprints, cut into shards by the
leading bits. The filters of a shard merge losslessly, remainder by remainder in sorted order, so a fingerprint
counted more than once anywhere is known without moving a text. Only documents with such a fingerprint go on to
the byte comparison, a grouping on the normalised text itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_binary, ascii_lower, batches, free_name, id_text, shuffle_partitions, written

LOAD = 0.75


class CountingQuotientFilter:
    """A multiset of `bits`-bit fingerprints in quotient-filter form.

    The upper `q` bits of a fingerprint (its quotient) name its home slot, the rest (its remainder) is stored. Runs
    are sorted and shifted right by linear probing; `occupied` marks quotients that have a run, `runend` the last slot
    of each run. A slot counted more than once has a bit in `counted` and its count in `counts`.
    """

    def __init__(self, bits: int, q: int, occupied: np.ndarray, runend: np.ndarray, remainders: np.ndarray, counted: np.ndarray, counts: np.ndarray):
        self.bits, self.q = bits, q
        self.occupied, self.runend, self.remainders, self.counted, self.counts = occupied, runend, remainders, counted, counts

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray | None = None, bits: int = 64) -> CountingQuotientFilter:
        """Of fingerprints in any order, each counted once or as given."""
        values, inverse = np.unique(fingerprints.astype(np.uint64), return_inverse=True)
        total = np.bincount(inverse, weights=counts, minlength=len(values)).astype(np.int64) if len(values) else np.zeros(0, np.int64)
        return cls._of_sorted(values, total, bits)

    @classmethod
    def _of_sorted(cls, values: np.ndarray, total: np.ndarray, bits: int) -> CountingQuotientFilter:
        """Of ascending fingerprints, each once, and their counts."""
        q = max(1, int(np.ceil(np.log2(max(2, len(values) / LOAD)))))
        quotient = (values >> np.uint64(bits - q)).astype(np.int64)
        at = np.arange(len(values))
        slot = at + np.maximum.accumulate(quotient - at) if len(values) else at
        slots = max((1 << q), int(slot[-1]) + 1 if len(values) else 0)
        occupied, runend, counted = np.zeros(1 << q, bool), np.zeros(slots, bool), np.zeros(slots, bool)
        remainders = np.zeros(slots, np.uint64)
        occupied[quotient] = True
        if len(values):
            runend[slot[np.append(quotient[1:] != quotient[:-1], True)]] = True
        remainders[slot] = values & np.uint64((1 << (bits - q)) - 1)
        counted[slot[total > 1]] = True
        return cls(bits, q, occupied, runend, remainders, counted, total[total > 1])

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints in ascending order and their counts, read back from the slots."""
        quotients, ends = np.flatnonzero(self.occupied), np.flatnonzero(self.runend)
        starts = np.maximum(quotients, np.concatenate([[0], ends[:-1] + 1])) if len(ends) else ends
        lengths = ends - starts + 1
        slot = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum()) if len(ends) else ends
        values = (np.repeat(quotients, lengths).astype(np.uint64) << np.uint64(self.bits - self.q)) | self.remainders[slot]
        counts = np.ones(len(slot), np.int64)
        counts[self.counted[slot]] = self.counts
        return values, counts

    def merge(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        """The filter of both multisets: two sorted streams of remainders become one, equal ones add their counts."""
        (a, n), (b, m) = self.items(), other.items()
        at = np.searchsorted(b, a)  # both streams are sorted: each value of one knows its place in the other
        both = np.zeros(len(a), bool) if not len(b) else b[np.minimum(at, len(b) - 1)] == a
        m = m.copy()
        m[at[both]] += n[both]
        a, n, at = a[~both], n[~both], at[~both]
        return CountingQuotientFilter._of_sorted(np.insert(b, at, a), np.insert(m, at, n), self.bits)

    def dump(self) -> bytes:
        wide = (self.bits - self.q + 7) // 8
        packed = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]
        head = np.array([self.bits, self.q, len(self.runend), len(self.counts)], "<i8").tobytes()
        return b"".join([head, np.packbits(self.occupied).tobytes(), np.packbits(self.runend).tobytes(), np.packbits(self.counted).tobytes(), self.counts.astype("<i8").tobytes(), packed.tobytes()])

    @classmethod
    def load(cls, data: bytes) -> CountingQuotientFilter:
        bits, q, slots, n = (int(x) for x in np.frombuffer(data, "<i8", 4))
        at = 32

        def bitmap(size: int) -> np.ndarray:
            nonlocal at
            out = np.unpackbits(np.frombuffer(data, np.uint8, (size + 7) // 8, at), count=size).astype(bool)
            at += (size + 7) // 8
            return out

        occupied, runend, counted = bitmap(1 << q), bitmap(slots), bitmap(slots)
        counts = np.frombuffer(data, "<i8", n, at)
        wide = (bits - q + 7) // 8
        raw = np.zeros((slots, 8), np.uint8)
        raw[:, :wide] = np.frombuffer(data, np.uint8, slots * wide, at + 8 * n).reshape(slots, wide)
        return cls(bits, q, occupied, runend, raw.view("<u8").ravel(), counted, counts)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, 64-bit fingerprint and SHA-256 of each text after lower-casing A-Z."""

    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 2000):
            texts = as_binary(pc.ascii_lower(b.column(1)))
            fp = np.fromiter((xxhash.xxh3_64_intdigest(t) for t in texts), np.uint64, len(texts)).view(np.int64)
            sha = [hashlib.sha256(t).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), pa.array(sha, pa.string())], ["doc_id", "fp", "text_sha256"])

    return id_text(docs, id_col, text_col).mapInArrow(of, "doc_id long, fp long, text_sha256 string")


def repeated_fingerprints(prints: DataFrame) -> DataFrame:
    """The values of column fp that occur more than once: filters per task, merged shard by shard."""
    shard_bits = max(1, int(np.ceil(np.log2(shuffle_partitions(prints.sparkSession)))))
    bits = 64 - shard_bits

    def build(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:  # a filter for each batch and shard: what a task holds does not depend on its partition's size
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            shard, rest = (fp >> np.uint64(bits)).astype(np.int64), fp & np.uint64((1 << bits) - 1)
            order = np.argsort(shard, kind="stable")
            shards, first = np.unique(shard[order], return_index=True)
            filters = [CountingQuotientFilter.of(part, bits=bits).dump() for part in np.split(rest[order], first[1:])] if len(shards) else []
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array(filters, pa.binary())], ["shard", "filter"])

    def merge(key: tuple, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: list[CountingQuotientFilter] = []
        for b in it:
            for data in b.column("filter").to_pylist():
                whole.append(CountingQuotientFilter.load(data))
                while len(whole) > 1 and whole[-2].q <= whole[-1].q:  # merge equals with equals, as a binary counter does
                    whole.append(whole.pop().merge(whole.pop()))
        while len(whole) > 1:
            whole.append(whole.pop().merge(whole.pop()))
        values, counts = whole[0].items()
        again = (values[counts > 1] | (np.uint64(key[0].as_py()) << np.uint64(bits))).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(again)], ["fp"])

    filters = prints.select("fp").mapInArrow(build, "shard long, filter binary")
    return filters.groupBy("shard").applyInArrow(merge, "fp long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; of equal texts the row with the largest id stays. A null text
    counts as empty, so null and empty texts are equal. A null id is smaller than any other. Rows that repeat the
    largest id of their group all have kept = true. An empty table gives an empty result; other columns are ignored.
    """
    prints = written(fingerprints(docs, id_col, text_col), "fingerprints")
    again = repeated_fingerprints(prints)
    routed = prints.join(again, "fp", "left_semi").select(F.col("doc_id").alias("routed_id"))
    texts = id_text(docs, id_col, text_col)
    texts = texts.join(routed, F.col("doc_id").eqNullSafe(F.col("routed_id")), "left_semi")
    same = texts.groupBy(ascii_lower(F.col("text")).cast("binary").alias("bytes")).agg(F.max("doc_id").alias("group_keep"), F.count(F.lit(1)).alias("n"))
    same = same.where("n > 1").select(F.sha2("bytes", 256).alias("text_sha256"), "group_keep", "n")
    return prints.join(same, "text_sha256", "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("group_keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | F.col("doc_id").eqNullSafe(F.col("group_keep"))).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows whose text a row with a larger id repeats; the columns stay as they are.

    An id stands for a document: rows that share one, a null one too, stay together if any of them is kept. Null texts are
    copies of empty ones; an empty table gives an empty result.
    """
    name = free_name(docs, "kept_id")
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias(name))
    return docs.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col(name)), "left_semi")
