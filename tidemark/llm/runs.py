"""Runs: stretches of words that repeat with a period, found by seeds on diagonals that are extended.

A run of period q and at least four periods agrees with itself shifted by q over three periods or more, and over five words at
least. So k-grams of five words are in every run; for longer periods k doubles, and grams of k words look for the
periods above k/2 up to k, which three periods always hold. As k is no less than the period, a gram inside a run first recurs exactly
one period later (a primitive word does not lie within its own square elsewhere): the pairs of consecutive occurrences
in a document are seeds enough, and no list of all pairs is needed. A seed is extended along its diagonal, and a table of how far
each lag is covered passes over the seeds that lie in a stretch already extended. Grams are named exactly, not hashed:
a longer gram's name is that of its two halves, and only grams that recur in their document are taken on.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_bytes, id_text, mix64, split_words

#: The words of the first grams: what every run has in common with itself one period on.
SEED = 5
#: Bytes of text in a batch, unless a single text has more.
BATCH_BYTES = 4 << 20
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _name_first(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their first grams, and whether each begins another gram than the one before."""
    seed = 0
    while True:
        h = np.full(len(at), seed, np.uint64)
        for k in range(SEED):
            h = mix64(h * np.uint64(31) + codes[at + k].astype(np.uint64) + np.uint64(1))
        order = np.argsort(h, kind="stable")
        new = np.ones(len(at), bool)
        new[1:] = h[order][1:] != h[order][:-1]
        a, b = at[order[:-1]][~new[1:]], at[order[1:]][~new[1:]]
        if all((codes[a + k] == codes[b + k]).all() for k in range(SEED)):
            return order, new
        seed += 1  # two grams have one hash: another hash then


def seeds(codes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length k of grams: k, and the consecutive occurrences (position, lag) of grams within a document whose lag k answers for."""
    size = np.diff(offsets)
    doc = np.repeat(np.arange(len(size)), size)
    most = size // 4  # a run has four periods
    at = np.arange(len(codes))
    at = at[(at + SEED <= offsets[1:][doc]) & (most[doc] >= 1)]
    k, name = SEED, np.zeros(0, np.int64)
    while len(at):
        if k == SEED:
            order, new = _name_first(codes, at)
        else:
            order = np.argsort(name, kind="stable")
            new = np.ones(len(at), bool)
            new[1:] = name[order][1:] != name[order][:-1]
        label = np.empty(len(at), np.int64)
        label[order] = np.cumsum(new)
        a, b = order[:-1], order[1:]  # neighbours among the occurrences of a gram, in the order of the text
        near = ~new[1:] & (doc[at[a]] == doc[at[b]])
        a, b = a[near], b[near]
        lag = at[b] - at[a]
        near = lag <= most[doc[at[a]]]
        a, b, lag = a[near], b[near], lag[near]
        mine = (lag <= k) & ((lag > k // 2) | (k == SEED))
        yield k, at[a[mine]], lag[mine]
        alive = np.zeros(len(at), bool)
        alive[a] = alive[b] = True
        alive &= most[doc[at]] > k
        at, label = at[alive], label[alive]
        second = np.searchsorted(at, at + k)
        there = second < len(at)
        there[there] = at[second[there]] == at[there] + k
        there &= doc[at] == doc[np.minimum(at + k, len(doc) - 1)] if len(at) else there
        name = label[there] * (label.max(initial=0) + 1) + label[second[there]]
        at, k = at[there], 2 * k


def _agree(codes: np.ndarray, at: int, lag: int, end: int) -> int:
    """The first position from `at` on, below end, whose word differs from the one `lag` later."""
    step = 64
    while at < end:
        stop = min(at + step, end)
        same = codes[at:stop] == codes[at + lag : stop + lag]
        if not same.all():
            return at + int(np.argmin(same))
        at, step = stop, 2 * step
    return end


def _agree_back(codes: np.ndarray, at: int, lag: int, start: int) -> int:
    """The first position of the stretch of such words that ends before `at`."""
    step = 64
    while at > start:
        stop = max(at - step, start)
        same = codes[stop:at] == codes[stop + lag : at + lag]
        if not same.all():
            return stop + int(np.flatnonzero(~same)[-1]) + 1
        at, step = stop, 2 * step
    return start


def find_runs(codes: np.ndarray, offsets: np.ndarray, periods: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    """start, length, period of every run of the texts whose word numbers lie in codes from offset to offset, by start and period."""
    found = []
    furthest: dict[int, int] = {}
    for k, at, lag in seeds(codes, offsets):
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        first = np.ones(len(at), bool)  # seeds side by side lie in one stretch
        first[1:] = (at[1:] != at[:-1] + 1) | (lag[1:] != lag[:-1])
        homes = np.searchsorted(offsets, at[first], "right") - 1
        for i, q, d in zip(at[first].tolist(), lag[first].tolist(), homes.tolist(), strict=True):
            if furthest.get(q, -1) > i:
                continue
            start, end = _agree_back(codes, i, q, int(offsets[d])), _agree(codes, i + k, q, int(offsets[d + 1]) - q)
            furthest[q] = end
            if end + q - start >= max(least, periods * q):
                found.append((start, end + q - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    Words are [^\\x20\\x09-\\x0D]+, numbered from 0. A run is a longest stretch of words whose smallest period is `period`, of four periods and
    six words at least. collapsed holds the words, joined by one space, but for those that some run has beyond its first period. A null
    text counts as empty: no words, no runs, an empty collapsed text; a null id stays null; rows that repeat have equal results; other columns are
    ignored; an empty table gives an empty result. A text is one task's work, in memory that grows with that text alone.
    """

    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(it, BATCH_BYTES):
            words, codes, offsets = split_words(b.column(1), lower=False)
            codes = codes.astype(np.int64)
            found = find_runs(codes, offsets)
            start = np.array([r[0] for r in found], np.int64)
            length = np.array([r[1] for r in found], np.int64)
            period = np.array([r[2] for r in found], np.int64)
            home = np.searchsorted(offsets, start, "right") - 1
            ends = np.searchsorted(home, np.arange(b.num_rows + 1)).astype(np.int32)
            step = np.zeros(len(codes) + 1, np.int64)
            np.add.at(step, start + period, 1)
            np.add.at(step, start + length, -1)
            keep = np.cumsum(step[:-1]) == 0
            kept = np.concatenate([[0], np.cumsum(keep)])[offsets]
            lists = pa.ListArray.from_arrays(pa.array(kept.astype(np.int32)), words.take(pa.array(codes[keep])))
            runs = pa.StructArray.from_arrays([pa.array(start - offsets[home]), pa.array(length), pa.array(period)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(offsets)), pa.ListArray.from_arrays(pa.array(ends), runs), pc.binary_join(lists, " ")],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    schema = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return id_text(docs, id_col, text_col).mapInArrow(of, schema)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text, in which texts chosen by the checksum of their id repeat themselves from some word on.

    With h the CRC-32 of the id in decimal and g = h // 10, texts with h % 10 = 0 and n > 0 words have word a + (i - a) % p in
    place of every word i from a on, where a = g % n and p = 1 + (n - a) // (3 + g % 8). Null ids are never chosen.
    """

    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_bytes(it, BATCH_BYTES):
            text = []
            for id_, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                h = 1 if id_ is None else zlib.crc32(str(id_).encode())
                words = _WORD.findall(t.as_py()) if h % 10 == 0 else []
                if words:
                    g, n = h // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    t = " ".join(words[:a] + [words[a + i % p] for i in range(n - a)])
                else:
                    t = t.as_py()
                text.append(t)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, b.schema.field(1).type)], ["doc_id", "text"])

    return id_text(docs, id_col, text_col).mapInArrow(of, "doc_id long, text string")


def run_digests(runs: DataFrame) -> DataFrame:
    """From periodic_runs: doc_id, n_runs, the longest run (ties: smallest start, then period), and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("under"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    rows = runs.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.under")
    return rows.select(
        "doc_id",
        "n_runs",
        (-F.col("best.before")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
