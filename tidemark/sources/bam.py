"""BAM files as a Spark data source: read by ranges of compressed bytes, written a file for each partition.

A BAM file is a row of BGZF blocks, gzip members that state their own size. A reading task gets a range of bytes, finds the
first block that begins in it and, as records go over the ends of blocks, the first place in the blocks' data from which on records chain. It
reads the records that begin in blocks that begin in its range, the last one to its end. So no file is read whole by one task,
and each record is read once, whatever the ranges.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from tidemark.functions import ragged

SCHEMA = "name string, flag int, chrom string, start long, end long, strand string, mapq int, cigar string, mate_chrom string, mate_start long, tlen int, seq string, qual string, tags map<string,string>"
#: Bytes of a range, and rows and bytes of a batch.
SPLIT, ROWS, BYTES = 32 << 20, 2000, 8 << 20
#: Fixed values of the format: letters of bases and of CIGAR operations, and which operations use up the reference.
BASES, OPS, ON_REFERENCE = b"=ACMGRSVTWYHKDBN", "MIDNSHP=X", (0, 2, 3, 7, 8)
_FIXED = struct.Struct("<iiBBHHHiiii")
_NUMBER = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I", "f": "<f"}
_PAIRS = np.frombuffer(bytes(BASES[k] for n in range(256) for k in (n >> 4, n & 15)), np.uint8).reshape(256, 2)
_CHAIN = 6
#: The fixed part of a record, its size before it, and the code of each letter.
_PART = np.dtype([("ref", "<i4"), ("pos", "<i4"), ("name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("ops", "<u2"), ("flag", "<u2"), ("bases", "<i4"), ("mate", "<i4"), ("mate_pos", "<i4"), ("tlen", "<i4")])
_WHOLE = np.dtype([("size", "<i4"), *_PART.descr])
_CODES = np.array([BASES.index(c) if c in BASES else 15 for c in bytes(range(256)).upper()], np.uint8)
_ARROW = pa.schema(
    [(c, t) for c, t in zip(["name", "flag", "chrom", "start", "end", "strand", "mapq", "cigar", "mate_chrom", "mate_start", "tlen", "seq", "qual", "tags"],
    [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string())], strict=True)]
)


# --- blocks ---


def block_size(data: bytes, at: int) -> int | None:
    """The size of the BGZF block at a place, or None where none begins."""
    if data[at : at + 4] != b"\x1f\x8b\x08\x04" or len(data) < at + 18:
        return None
    end = at + 12 + int.from_bytes(data[at + 10 : at + 12], "little")
    i = at + 12
    while i + 4 <= min(end, len(data)):
        n = int.from_bytes(data[i + 2 : i + 4], "little")
        if data[i : i + 2] == b"BC" and n == 2 and i + 6 <= len(data):
            return int.from_bytes(data[i + 4 : i + 6], "little") + 1
        i += 4 + n
    return None


def inflate(block: bytes) -> bytes:
    head = 12 + int.from_bytes(block[10:12], "little")
    data = zlib.decompress(block[head:-8], -15)
    if len(data) != int.from_bytes(block[-4:], "little") or zlib.crc32(data) != int.from_bytes(block[-8:-4], "little"):
        raise ValueError("a block's data do not agree with its checksum")
    return data


def deflate(data: bytes) -> bytes:
    """Data as BGZF blocks."""
    out = []
    for at in range(0, len(data), 0xFF00):
        part = data[at : at + 0xFF00]
        squeezed = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = squeezed.compress(part) + squeezed.flush()
        out.append(struct.pack("<4BIBBH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(part), len(part)))
    return b"".join(out)


#: Fixed value of the format: the empty block that ends a file.
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


class Stream:
    """The data of blocks from a place in a file on; for each byte, where its block begins."""

    def __init__(self, file, size: int, at: int):
        self.file, self.size, self.at = file, size, at
        self.data, self.dropped = bytearray(), 0
        self.starts: list[tuple[int, int]] = []  # offset of the data, place of the block
        self.raw, self.raw_at = b"", at

    def _fetch(self, n: int) -> bytes:
        if self.at + n > self.raw_at + len(self.raw):
            self.file.seek(self.at)
            self.raw, self.raw_at = self.file.read(max(n, 1 << 20)), self.at
        return self.raw[self.at - self.raw_at : self.at - self.raw_at + n]

    def more(self) -> bool:
        if self.at >= self.size:
            return False
        size = block_size(self._fetch(min(4096, self.size - self.at)), 0)
        if size is None:
            raise ValueError(f"no block at byte {self.at}")
        data = inflate(self._fetch(size))
        if data:
            self.starts.append((self.dropped + len(self.data), self.at))
        self.at += size
        self.data += data
        return True

    def need(self, end: int) -> bool:
        """Whether there are data up to an offset."""
        while self.dropped + len(self.data) < end:
            if not self.more():
                return False
        return True

    def get(self, at: int, n: int) -> bytes:
        return bytes(self.data[at - self.dropped : at - self.dropped + n])

    def block_of(self, at: int) -> int:
        """Where the block of a byte begins; bytes before are not asked for again."""
        while len(self.starts) > 1 and self.starts[1][0] <= at:
            self.starts.pop(0)
        return self.starts[0][1]

    def drop(self, at: int) -> None:
        if at - self.dropped > 1 << 20:
            del self.data[: at - self.dropped]
            self.dropped = at


def first_block(file, size: int, at: int) -> int:
    """Where the first block from a place on begins, or the file's size."""
    file.seek(at)
    data = file.read(min(3 << 16, size - at))
    i = data.find(b"\x1f\x8b\x08\x04")
    while i >= 0:
        n = block_size(data, i)
        if n and i + n <= len(data) and (at + i + n == size or block_size(data, i + n)):
            try:
                inflate(data[i : i + n])
                return at + i
            except (zlib.error, ValueError):
                pass
        i = data.find(b"\x1f\x8b\x08\x04", i + 1)
    return size


# --- records ---


def read_header(stream: Stream) -> tuple[list[tuple[str, int]], int]:
    """Names and lengths of the contigs, and where the records begin."""
    if not stream.need(12) or stream.get(0, 4) != b"BAM\1":
        raise ValueError("not a BAM file")
    at = 8 + int.from_bytes(stream.get(4, 4), "little")
    stream.need(at + 4)
    contigs, n = [], int.from_bytes(stream.get(at, 4), "little")
    at += 4
    for _ in range(n):
        stream.need(at + 4)
        size = int.from_bytes(stream.get(at, 4), "little")
        stream.need(at + 8 + size)
        contigs.append((stream.get(at + 4, size - 1).decode(), int.from_bytes(stream.get(at + 4 + size, 4), "little")))
        at += 8 + size
    return contigs, at


def _tags_end(data: bytes, at: int) -> bool:
    """Whether tags from a place on fill the data to its end."""
    while at < len(data):
        kind = data[at + 2 : at + 3].decode("latin-1")
        at += 3
        if kind in ("Z", "H"):
            at = data.find(0, at) + 1
            if not at:
                return False
        elif kind == "A":
            at += 1
        elif kind == "B":
            sub = data[at : at + 1].decode("latin-1")
            if sub not in _NUMBER:
                return False
            at += 5 + int.from_bytes(data[at + 1 : at + 5], "little") * struct.calcsize(_NUMBER[sub])
        elif kind in _NUMBER:
            at += struct.calcsize(_NUMBER[kind])
        else:
            return False
    return at == len(data)


def _plausible(stream: Stream, at: int, contigs: int) -> int | None:
    """The end of what could be a record at a place: its fixed part, name, operations and tags must all hold. What the file's end cuts off is not judged by its tags."""
    if not stream.need(at + 36):
        return None
    size = int.from_bytes(stream.get(at, 4), "little", signed=True)
    ref, pos, name, _, _, ops, _, bases, mate, mate_pos, _ = _FIXED.unpack(stream.get(at + 4, 32))
    fixed = 32 + name + 4 * ops + (bases + 1) // 2 + bases
    if not (-1 <= ref < contigs and -1 <= mate < contigs and pos >= -1 and mate_pos >= -1 and name > 0 and bases >= 0 and fixed <= size <= fixed + (1 << 24)):
        return None
    if not stream.need(at + 36 + name + 4 * ops):
        return None
    text = stream.get(at + 36, name)
    if text[-1] != 0 or not all(33 <= c <= 126 for c in text[:-1]):
        return None
    if any(c & 15 >= len(OPS) for c in stream.get(at + 36 + name, 4 * ops)[::4]):
        return None
    if stream.need(at + 4 + size) and not _tags_end(stream.get(at + 4 + fixed, size - fixed), 0):
        return None
    return at + 4 + size


def first_record(stream: Stream, contigs: int, end: int) -> int | None:
    """The first offset from which on records chain and whose block begins before `end`."""
    at = 0
    while stream.need(at + 1):
        if stream.block_of(at) >= end:
            return None
        place, links = _plausible(stream, at, contigs), 0
        while place is not None and links < _CHAIN and stream.need(place + 1):
            place, links = _plausible(stream, place, contigs), links + 1
        if place is not None:
            return at
        at += 1
    return None


def _tags(data: bytes) -> dict[str, object]:
    out: dict[str, object] = {}
    at = 0
    while at < len(data):
        tag, kind = data[at : at + 2].decode(), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            end = data.index(0, at)
            out[tag], at = data[at:end].decode(), end + 1
        elif kind == "A":
            out[tag], at = chr(data[at]), at + 1
        elif kind == "B":
            sub, n = chr(data[at]), int.from_bytes(data[at + 1 : at + 5], "little")
            values = np.frombuffer(data, _NUMBER[sub][0] + {"c": "i1", "C": "u1", "s": "i2", "S": "u2", "i": "i4", "I": "u4", "f": "f4"}[sub], n, at + 5)
            out[tag], at = (sub, values), at + 5 + values.nbytes
        else:
            value = struct.unpack_from(_NUMBER[kind], data, at)[0]
            out[tag], at = (f"{value:g}" if kind == "f" else str(value)), at + struct.calcsize(_NUMBER[kind])
    return out


def _as_text(tags: dict[str, object]) -> list[tuple[str, str]]:
    return [(k, ",".join([v[0], *(f"{x:g}" if v[0] == "f" else str(x) for x in v[1].tolist())]) if isinstance(v, tuple) else v) for k, v in tags.items()]


def _cigar(ops: np.ndarray) -> tuple[str, int]:
    """Operations as text, and how much of the reference they use."""
    words = ops.tolist()
    return "".join([f"{x >> 4}{OPS[x & 15]}" for x in words]) or "*", sum([x >> 4 for x in words if x & 15 in ON_REFERENCE])


def decode(record: bytes, contigs: list[str]) -> tuple:
    """A record, without its size, as a row."""
    ref, pos, n_name, mapq, _, n_ops, flag, n_bases, mate, mate_pos, tlen = _FIXED.unpack_from(record)
    at = 32 + n_name
    ops = np.frombuffer(record, "<u4", n_ops, at)
    at += 4 * n_ops
    seq = _PAIRS[np.frombuffer(record, np.uint8, (n_bases + 1) // 2, at)].ravel()[:n_bases].tobytes().decode() or "*"
    at += (n_bases + 1) // 2
    quality = np.frombuffer(record, np.uint8, n_bases, at)
    tags = _tags(record[at + n_bases :])
    long = tags.get("CG")
    if n_ops == 2 and isinstance(long, tuple) and ops[0] == n_bases << 4 | 4 and ops[1] & 15 == 3:  # more operations than a record has room for
        ops = tags.pop("CG")[1]
    qual = "*" if not n_bases or quality[0] == 255 else (quality + 33).tobytes().decode()
    cigar, used = _cigar(ops)
    text = _as_text(tags)
    name = record[32 : 31 + n_name].decode()
    return name, flag, contigs[ref] if ref >= 0 else None, pos, pos + used, "-" if flag & 16 else "+", mapq, cigar, contigs[mate] if mate >= 0 else None, mate_pos, tlen, seq, qual, text


def _alike(data: bytes, begin: np.ndarray, end: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The different pieces of data, and which of them each one is."""
    seen: dict[bytes, int] = {}
    which = np.array([seen.setdefault(data[a:b], len(seen)) for a, b in zip(begin.tolist(), end.tolist(), strict=True)], np.int64)
    return list(seen), which


def decode_all(data: bytes, at: np.ndarray, size: np.ndarray, contigs: list[str]) -> pa.RecordBatch:
    """decode for many records, which begin at `at` without their size: operations and tags that repeat are read once."""
    raw = np.frombuffer(data, np.uint8)
    part = raw[at[:, None] + np.arange(_PART.itemsize)].view(_PART)[:, 0]
    n_name, n_ops, n = np.maximum(part["name"].astype(np.int64), 1), part["ops"].astype(np.int64), part["bases"].astype(np.int64)
    on_ops = at + 32 + n_name
    on_seq = on_ops + 4 * n_ops
    on_qual = on_seq + (n + 1) // 2
    names = raw[ragged.places(at + 32, n_name - 1)]
    missing = (n == 0) | (raw[np.minimum(on_qual, len(raw) - 1)] == 255)
    n_qual = np.where(missing, 0, n)
    qual = raw[ragged.places(on_qual, n_qual)]
    tags, of_tags = _alike(data, on_qual + n, at + size)
    tags = [_tags(x) for x in tags]
    if names.max(initial=0) > 127 or qual.max(initial=0) > 126 - 33 or any("CG" in x for x in tags):
        return _batch([decode(data[a : a + b], contigs) for a, b in zip(at.tolist(), size.tolist(), strict=True)])
    ops, of_ops = _alike(data, on_ops, on_seq)
    ops = [_cigar(np.frombuffer(x, "<u4")) for x in ops]
    seq = _PAIRS[raw[ragged.places(on_seq, (n + 1) // 2)]].ravel()
    keep = np.ones(len(seq), bool)
    keep[np.cumsum(n + n % 2)[n % 2 == 1] - 1] = False  # the half byte beyond an odd number of bases
    whole = pa.array(contigs, pa.string())
    contig = lambda x: whole.take(pa.array(x, pa.int64(), mask=x < 0))
    star = lambda none, x: pc.if_else(pa.array(none), pa.scalar("*"), x)
    start = part["pos"].astype(np.int64)
    used = np.array([u for _, u in ops], np.int64)[of_ops]
    columns = [
        ragged.texts(names, n_name - 1), part["flag"], contig(part["ref"]), start, start + used, pa.array(["+", "-"]).take(pa.array(part["flag"] >> 4 & 1)), part["mapq"], pa.array([x for x, _ in ops], pa.string()).take(pa.array(of_ops)), contig(part["mate"]), part["mate_pos"], part["tlen"],
        star(n == 0, ragged.texts(seq[keep], n)), star(missing, ragged.texts(qual + 33, n_qual)), pa.array([_as_text(x) for x in tags], _ARROW.field("tags").type).take(pa.array(of_tags)),
    ]
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x.astype(f.type.to_pandas_dtype())) for x, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def _bin(start: int, end: int) -> int:
    """The smallest of the format's nested bins that holds an interval."""
    for shift, first in ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1)):
        if start >> shift == (end - 1) >> shift:
            return first + (start >> shift)
    return 0


def _ops(cigar: str | None) -> list[int]:
    ops = []
    n = ""
    for c in cigar if cigar not in (None, "*") else "":
        if c.isdigit():
            n += c
        else:
            ops.append(int(n) << 4 | OPS.index(c))
            n = ""
    return ops


def encode(row: dict, number: dict[str, int]) -> bytes:
    """A row as a record with its size; tags become text."""
    ops = _ops(row["cigar"])
    seq = b"" if row["seq"] in (None, "*") else row["seq"].encode()
    codes = np.array([BASES.index(c) if c in BASES else 15 for c in seq.upper()] + [0] * (len(seq) % 2), np.uint8)
    qual = b"\xff" * len(seq) if row["qual"] in (None, "*") else bytes(c - 33 for c in row["qual"].encode())
    if len(qual) != len(seq):
        raise ValueError(f"a sequence and a quality of two lengths: {row['name']}")
    tags = b"".join(k.encode() + b"Z" + v.encode() + b"\0" for k, v in row["tags"] or ())
    name, start = row["name"].encode() + b"\0", row["start"]
    more = struct.pack(f"<{len(ops)}I", *ops)
    if len(ops) > 0xFFFF:
        used = sum(x >> 4 for x in ops if x & 15 in ON_REFERENCE)
        tags += b"CGBI" + struct.pack("<I", len(ops)) + more
        more = struct.pack("<2I", len(seq) << 4 | 4, used << 4 | 3)
    place = (number.get(row["chrom"], -1), start, len(name), row["mapq"], _bin(max(start, 0), max(row["end"], start + 1, 1)), len(more) // 4, row["flag"], len(seq), number.get(row["mate_chrom"], -1), row["mate_start"], row["tlen"])
    body = _FIXED.pack(*place) + name + more + (codes[::2] << 4 | codes[1::2]).tobytes() + qual + tags
    return struct.pack("<i", len(body)) + body


def encode_all(batch: pa.RecordBatch, number: dict[str, int]) -> bytes:
    """encode for all rows of a batch, one after the other. What does not fit into a record, or needs the tag of long operations, goes row by row."""
    singly = lambda: b"".join(encode(r, number) for r in batch.to_pylist())
    column = {c: x for c, x in zip(batch.schema.names, batch.columns, strict=True)}
    tags = column["tags"]
    if not batch.num_rows or any(column[c].null_count for c in ("name", "flag", "start", "end", "mapq", "mate_start", "tlen", "tags")):
        return singly()
    value = {c: column[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("flag", "start", "end", "mapq", "mate_start", "tlen")}
    bounds = {"flag": (0, 0xFFFF), "mapq": (0, 0xFF), "start": (-(1 << 31), (1 << 31) - 1), "mate_start": (-(1 << 31), (1 << 31) - 1)}
    names, n_name = ragged.letters(column["name"])
    coded = column["cigar"].cast(pa.string()).fill_null("*").dictionary_encode()
    ops = [np.array(_ops(x), "<u4") for x in coded.dictionary.to_pylist()]
    n_ops, which = np.array([len(x) for x in ops], np.int64), coded.indices.to_numpy()
    begin, end = np.maximum(value["start"], 0), np.maximum(np.maximum(value["end"], value["start"] + 1), 1)
    bins = np.zeros(len(begin), np.int64)
    for shift, first in ((26, 1), (23, 9), (20, 73), (17, 585), (14, 4681)):
        bins = np.where(begin >> shift == (end - 1) >> shift, first + (begin >> shift), bins)
    if any(((x < low) | (x > high)).any() for x, (low, high) in ((value[c], b) for c, b in bounds.items())) or n_name.max(initial=0) > 254 or n_ops.max(initial=0) > 0xFFFF or bins.max(initial=0) > 0xFFFF:
        return singly()
    given = {c: pc.not_equal(column[c].cast(pa.string()).fill_null("*"), "*") for c in ("seq", "qual")}
    seq, n = ragged.letters(pc.if_else(given["seq"], column["seq"].cast(pa.string()), ""))
    qual, n_qual = ragged.letters(pc.if_else(given["qual"], column["qual"].cast(pa.string()), ""))
    has = given["qual"].to_numpy(zero_copy_only=False)
    keys, items = (x.slice(tags.offsets[0].as_py(), tags.offsets[-1].as_py() - tags.offsets[0].as_py()) for x in (tags.keys, tags.items))
    if (n_qual[has] != n[has]).any() or qual.min(initial=33) < 33 or items.null_count:
        return singly()
    half = (n + 1) // 2
    codes = np.zeros(2 * int(half.sum()), np.uint8)
    codes[ragged.places(2 * (np.cumsum(half) - half), n)] = _CODES[seq]
    quality = np.full(int(n.sum()), 255, np.uint8)
    quality[ragged.places((np.cumsum(n) - n)[has], n[has])] = qual - 33
    (k, n_key), (v, n_item) = ragged.letters(keys), ragged.letters(items)
    long = n_key + n_item + 2
    at = np.cumsum(long) - long
    text = np.zeros(int(long.sum()), np.uint8)
    text[ragged.places(at, n_key)], text[at + n_key], text[ragged.places(at + n_key + 1, n_item)] = k, ord("Z"), v
    n_text = np.diff(np.concatenate([[0], np.cumsum(long)])[tags.offsets.to_numpy() - tags.offsets[0].as_py()])
    fixed = np.zeros(len(n), _WHOLE)
    contig = {c: column[c].cast(pa.string()).dictionary_encode() for c in ("chrom", "mate_chrom")}
    ref, mate = (np.array([*(number.get(c, -1) for c in x.dictionary.to_pylist()), -1], np.int64)[x.indices.fill_null(len(x.dictionary)).to_numpy()] for x in contig.values())
    size = 36 + n_name + 1 + 4 * n_ops[which] + half + n + n_text
    for c, x in zip(_WHOLE.names, (size - 4, ref, value["start"], n_name + 1, value["mapq"], bins, n_ops[which], value["flag"], n, mate, value["mate_start"], value["tlen"]), strict=True):
        fixed[c] = x
    out = np.zeros(int(size.sum()), np.uint8)
    at = np.cumsum(size) - size
    out[at[:, None] + np.arange(_WHOLE.itemsize)] = fixed.view(np.uint8).reshape(len(n), -1)
    at = at + 36
    out[ragged.places(at, n_name)] = names
    at = at + n_name + 1
    words = np.concatenate([*ops, np.zeros(0, "<u4")]).astype("<u4").view(np.uint8)
    out[ragged.places(at, 4 * n_ops[which])] = words[ragged.places(4 * (np.cumsum(n_ops) - n_ops)[which], 4 * n_ops[which])]
    at = at + 4 * n_ops[which]
    out[ragged.places(at, half)] = codes[::2] << 4 | codes[1::2]
    out[ragged.places(at + half, n)] = quality
    out[ragged.places(at + half + n, n_text)] = text
    return out.tobytes()


def header(contigs: list[tuple[str, int]]) -> bytes:
    text = "".join(f"@SQ\tSN:{c}\tLN:{n}\n" for c, n in contigs).encode()
    return b"BAM\1" + struct.pack("<I", len(text)) + text + struct.pack("<I", len(contigs)) + b"".join(struct.pack("<I", len(c) + 1) + c.encode() + b"\0" + struct.pack("<I", n) for c, n in contigs)


# --- the data source ---


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int
    size: int


class BamReader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def partitions(self) -> list[Range]:
        files, path = _open(self.path)
        info = files.get_file_info(path)
        found = [info] if info.is_file else [f for f in files.get_file_info(fs.FileSelector(path, recursive=True)) if f.is_file and f.path.endswith(".bam")]
        return [Range(f.path, at, min(at + self.split, f.size), f.size) for f in sorted(found, key=lambda f: f.path) for at in range(0, f.size, self.split)]

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        files, _ = _open(self.path)
        with files.open_input_file(part.path) as file:
            head = Stream(file, part.size, 0)
            contigs, at = read_header(head)
            names = [c for c, _ in contigs]
            if part.start:
                begin = first_block(file, part.size, part.start)
                if begin >= part.end:
                    return
                stream = Stream(file, part.size, begin)
                at = first_record(stream, len(names), part.end)
            else:
                stream = head
            begins: list[int] = []
            ends: list[int] = []

            def batch() -> pa.RecordBatch:
                begin, end = np.array(begins), np.array(ends)
                return decode_all(stream.get(begins[0], ends[-1] - begins[0]), begin - begins[0], end - begin, names)

            while at is not None and stream.need(at + 4) and stream.block_of(at) < part.end:
                size = int.from_bytes(stream.get(at, 4), "little")
                if not stream.need(at + 4 + size):
                    raise ValueError(f"{part.path} ends within a record")
                begins.append(at + 4)
                at += 4 + size
                ends.append(at)
                if len(begins) == ROWS or at - begins[0] > BYTES:
                    yield batch()
                    begins, ends = [], []
                    stream.drop(at)
            if begins:
                yield batch()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


@dataclass
class Written(WriterCommitMessage):
    path: str


class BamWriter(DataSourceArrowWriter):
    """A file for each partition, under a name that tells it to be unfinished until all are there."""

    def __init__(self, path: str, contigs: list[tuple[str, int]]):
        self.path, self.contigs = path, contigs

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        files, path = _open(self.path)
        files.create_dir(path, recursive=True)
        name = f"{path}/part-{uuid.uuid4().hex}.unfinished"
        number = {c: i for i, (c, _) in enumerate(self.contigs)}
        with files.open_output_stream(name) as out:
            out.write(deflate(header(self.contigs)))
            for b in batches:
                out.write(deflate(encode_all(b, number)))
            out.write(END)
        return Written(name)

    def commit(self, messages: list[Written | None]) -> None:
        files, _ = _open(self.path)
        for m in messages:
            if m:
                files.move(m.path, m.path.removesuffix("unfinished") + "bam")

    def abort(self, messages: list[Written | None]) -> None:
        files, _ = _open(self.path)
        for m in messages:
            if m:
                files.delete_file(m.path)


class Bam(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> BamReader:  # noqa: ANN001
        return BamReader(self.options["path"], int(self.options.get("split", SPLIT)))

    def writer(self, schema, overwrite: bool) -> BamWriter:  # noqa: ANN001
        pairs = [x.rsplit(":", 1) for x in self.options["contigs"].split("\t") if x]
        return BamWriter(self.options["path"], [(c, int(n)) for c, n in pairs])


def read_bam(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """Alignments of a BAM file, or of all in a folder, as read_sam gives them: 0-based, half-open; `split` is the bytes of a range."""
    spark.dataSource.register(Bam)
    return spark.read.format("bam").option("split", split).load(path)


def write_bam(alignments: DataFrame, contigs: list[tuple[str, int]], path: str) -> None:
    """Alignments (columns as read_bam gives them) as BAM files, one for each partition, in its order. contigs: names and lengths for the header."""
    alignments.sparkSession.dataSource.register(Bam)
    columns = [c.split(" ")[0] for c in SCHEMA.split(", ")]
    alignments.select(*[alignments[c].cast(t) for c, t in (x.split(" ") for x in SCHEMA.split(", "))]).toDF(*columns).write.format("bam").option("contigs", "\t".join(f"{c}:{n}" for c, n in contigs)).mode("append").save(path)
