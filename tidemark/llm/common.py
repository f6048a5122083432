"""What several corpus operators share: tables, the shared folder, and small numpy helpers."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a session on one machine gets a
    temporary folder; on a cluster it is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batch_bytes(spark: SparkSession, most: int | None):
    """Within it, what is run passes Arrow batches of at most so many bytes to Python."""
    usual = spark.conf.get(_BATCH_BYTES)
    try:
        if most:
            spark.conf.set(_BATCH_BYTES, str(most))
        yield
    finally:
        spark.conf.set(_BATCH_BYTES, usual)


def written(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
    """df, written once to the shared folder and read back: a cut in the lineage that outlives any executor.

    most bounds the bytes of the Arrow batches of this write alone, for rows with large values.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with batch_bytes(spark, most):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(c, _UPPER, _UPPER.lower())


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator reads, under fixed names; a null text is an empty one."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 on uint64 values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def as_binary(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def split_words(text: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words [^\\x20\\x09-\\x0D]+ of a batch of texts: distinct words, the index of each word, and for each text the offset of its first word (one more offset at the end)."""
    text = pc.fill_null(text, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text)
    flat = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    index = flat.indices.to_numpy(zero_copy_only=False)
    words = flat.dictionary
    blank = pc.index(words, pa.scalar("", words.type)).as_py()
    if blank >= 0:
        full = index != blank
        ends = np.concatenate([[0], np.cumsum(full)])
        index, offsets = index[full], ends[offsets]
    return words, index, offsets


def batches(it, rows: int):
    """Arrow batches of at most so many rows each; bounds what a task holds at once."""
    for b in it:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def by_bytes(it, most: int, column: int = 1):
    """Arrow batches with at most so many bytes in one column, unless a single row has more."""
    for b in it:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            yield b.slice(at, end - at)
            at = end


#: What a task says when a block's rows have changed under it.
CHANGED = "the input gave other rows when it was read again: write it to a table first"


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers in one compressed value, byte by byte so that equal leading bytes lie together."""
    parts = [np.array([len(arrays)], "<u4").tobytes()]
    for a in arrays:
        parts.append(a.dtype.str.encode().ljust(4) + np.array([len(a)], "<u4").tobytes())
        parts.append(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes())
    return zstandard.compress(b"".join(parts), 1)


def unpack_arrays(data: bytes) -> list[np.ndarray]:
    raw = zstandard.decompress(data)
    out, at = [], 4
    for _ in range(int(np.frombuffer(raw, "<u4", 1)[0])):
        kind, n = np.dtype(raw[at : at + 4].strip().decode()), int(np.frombuffer(raw, "<u4", 1, at + 4)[0])
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at + 8).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += 8 + n * kind.itemsize
    return out


#: Rows of one key that meet in a task of a join, on average, before they are dealt out.
DEAL = 1000


def dealt(rows: DataFrame, key: str, by: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """rows with a column `deal`, by which those of a frequent key go to several tasks, and what repeats the row of a key for each
    deal. Both sides then join on the key and `deal`."""
    many = rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / DEAL).cast("int").alias("deals")).where("deals > 1")
    deals = F.coalesce("deals", F.lit(1))
    out = rows.join(many, key, "left").withColumn("deal", F.pmod(F.xxhash64(by), deals).cast("long")).drop("deals")
    return out, lambda side: side.join(many, key, "left").withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), deals.cast("long") - 1))).drop("deals")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def values(table: pa.Table, *names: str) -> list[list]:
    """Columns of one side of a cogroup as lists; a side without rows has no columns."""
    return [table.column(n).to_pylist() if table.num_rows else [] for n in names]
