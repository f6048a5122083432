"""Near duplicates of embeddings: cross-polytope hashing after fast Hadamard rotations, with several probes a table.

1. Equal vectors of a label are one class. Each class goes to its nearest few buckets of every table.
2. Every bucket has a pivot, its smallest member; all others are compared with it, and what is confirmed joins components.
3. Buckets that still hold several components are looked at again: a pair that could be linked has one member that is not
   linked to the pivot, and by the triangle inequality both lie about as far from it. So members meet by bands of angle, a
   sketch of 128 signs refuses nearly all pairs, and the rest are confirmed on whole vectors.
4. All links lie within components. There they are counted, not listed: by matrix products of blocks of vectors, where
   blocks that are near enough to the component's first vector to be linked in any case, or too far apart, need no product.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batches, mix64, written
from .components import connected_components

LEAST = 0.98
TABLES, HASHES, PROBES = 5, 3, 4
#: Best vertices of a rotation that probes choose from.
TOP = 3
#: Rows of one vector that meet in a task when many are compared with it; vectors in a block of the count.
SALTS, CHUNK = 256, 2048
#: Cells of angle to a component's first vector within the angle of a link.
CELLS = 16
BATCH = 4096


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of vector, the rows that have it and can be compared, and the vectors scaled to length 1."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)  # a null component becomes NaN
    size = np.diff(offsets)
    present = ~np.asarray(column.is_null())
    for d in np.unique(size[present & (size > 0)]):
        rows = np.flatnonzero(present & (size == d))
        x = flat[offsets[:-1][rows][:, None] + np.arange(d)]
        with np.errstate(all="ignore"):
            most = np.abs(x).max(axis=1)
            good = np.isfinite(most) & (most > 0)
            x = x[good] / most[good, None]
            yield rows[good], x / np.sqrt((x * x).sum(axis=1))[:, None]


def _class_key(label: str, raw: np.ndarray) -> bytes:
    return hashlib.blake2b((raw + 0.0).tobytes(), digest_size=16, key=hashlib.blake2b(label.encode(), digest_size=32).digest()).digest()


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, width = x.shape
    h = 1
    while h < width:
        x = x.reshape(n, -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, width)
        h *= 2
    return x / math.sqrt(width)


def _rotation(x: np.ndarray, seed: int) -> np.ndarray:
    """Three rounds of random signs and the transform, from a seed."""
    for k in range(3):
        bits = mix64(np.arange(x.shape[1], dtype=np.uint64) + np.uint64(1 + 1_000_003 * (3 * seed + k)))
        x = hadamard(x * np.where(bits & np.uint64(1), 1.0, -1.0))
    return x


def buckets(unit: np.ndarray, salt: np.ndarray, tables: int, hashes: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the `probes` likeliest buckets of each table for every row, and the signs of its first 128 rotated components.

    A hash is the nearest vertex of the cross-polytope, a bucket one vertex for each of `hashes` rotations; probes go by the
    squared length that a vertex loses against the nearest.
    """
    n, d = unit.shape
    width = max(64, 1 << (d - 1).bit_length())
    x = np.zeros((n, width))
    x[:, :d] = unit
    choices = np.array(list(product(range(TOP), repeat=hashes)))
    keys, signs = np.empty((n, tables * probes), np.int64), []
    for t in range(tables):
        loss, vertex = np.zeros((n, len(choices))), np.zeros((n, len(choices)), np.uint64)
        for k in range(hashes):
            y = _rotation(x, t * hashes + k)
            if sum(s.shape[1] for s in signs) < 128:
                signs.append(y < 0)
            size = np.abs(y)
            best = np.argpartition(-size, TOP, axis=1)[:, :TOP]
            best = np.take_along_axis(best, np.argsort(-np.take_along_axis(size, best, 1), axis=1, kind="stable"), 1)
            top = np.take_along_axis(size, best, 1)
            corner = 2 * best + (np.take_along_axis(y, best, 1) < 0)
            loss += (top[:, :1] ** 2 - top**2)[:, choices[:, k]]
            vertex = mix64(vertex * np.uint64(31) + corner[:, choices[:, k]].astype(np.uint64) + np.uint64(k + 1))
        order = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        chosen = np.take_along_axis(vertex, order, 1)
        keys[:, t * probes : (t + 1) * probes] = mix64(chosen + salt[:, None] + np.uint64(7919 * t + d)).view(np.int64)
    bits = np.packbits(np.concatenate(signs, axis=1)[:, :128], axis=1).view("<i8")
    return keys, bits


def _sketches(rows: DataFrame, tables: int, hashes: int, probes: int) -> DataFrame:
    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for at in range(0, b.num_rows, BATCH):
                part = b.slice(at, BATCH)
                label, ids, column = part.column(1).to_pylist(), part.column(0), part.column(2)
                key: list = [None] * part.num_rows
                found: list = [None] * part.num_rows
                sketch: list = [None] * part.num_rows
                usable = np.array([x is not None for x in label], bool) & ids.is_valid().to_numpy(zero_copy_only=False)
                offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
                for at_row, unit in _matrices(column):
                    own = usable[at_row]
                    at_row, unit = at_row[own], unit[own]
                    if not len(at_row):
                        continue
                    salt = np.array([xxhash.xxh3_64_intdigest(label[i]) for i in at_row], np.uint64)
                    keys, bits = buckets(unit, salt, tables, hashes, probes)
                    for n, i in enumerate(at_row.tolist()):
                        key[i], found[i], sketch[i] = _class_key(label[i], flat[offsets[i] : offsets[i + 1]]), keys[n], bits[n]
                yield pa.RecordBatch.from_arrays(
                    [ids, part.column(1), pa.array(key, pa.binary()), pa.array(found, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64()))],
                    ["vec_id", "label", "class_key", "buckets", "sketch"],
                )

    return rows.mapInArrow(of, "vec_id long, label string, class_key binary, buckets array<long>, sketch array<long>")


def _units(rows: DataFrame) -> DataFrame:
    """The vectors of length 1, as doubles, with the keys of their classes."""

    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, BATCH):
            label, column = b.column(1).to_pylist(), b.column(2)
            offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
            key: list = [None] * b.num_rows
            data: list = [None] * b.num_rows
            for at_row, unit in _matrices(column):
                for n, i in enumerate(at_row.tolist()):
                    if label[i] is not None:
                        key[i], data[i] = _class_key(label[i], flat[offsets[i] : offsets[i + 1]]), unit[n].tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(key, pa.binary()), pa.array(data, pa.binary())], ["node", "class_key", "unit"])

    return rows.mapInArrow(of, "node long, class_key binary, unit binary").where("class_key IS NOT NULL")


def _cosines(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """a, b and the cosine of their vectors, for pairs of one label and length. Pairs of a frequent `a` are dealt out by b."""

    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, BATCH):
            x, y = b.column("unit_a"), b.column("unit_b")
            cos, size = np.empty(b.num_rows), np.array([len(v) for v in x.to_pylist()])
            for d in np.unique(size):
                at = pa.array(np.flatnonzero(size == d))
                side = [np.frombuffer(b"".join(c.take(at).to_pylist()), np.float64).reshape(len(at), -1) for c in (x, y)]
                cos[at.to_numpy()] = (side[0] * side[1]).sum(axis=1)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(cos)], ["a", "b", "cos"])

    side = lambda c: known.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}"), F.col("unit").alias(f"unit_{c}"))
    dealt = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(SALTS)).alias("salt"))
    left = dealt.select("a", "salt").distinct().join(side("a"), "a")
    both = dealt.join(side("b"), "b").join(left, ["a", "salt"]).where("label_a = label_b AND length(unit_a) = length(unit_b)")
    return both.select("a", "b", "unit_a", "unit_b").mapInArrow(of, "a long, b long, cos double")


def _open_pairs(rest: DataFrame, pivots: DataFrame, known: DataFrame, least: float) -> DataFrame:
    """Pairs a, b of different components in one bucket that may be linked (see the module's third step).

    rest: bucket, pivot, node, component. pivots: a (pivot), b (node), cos.
    """
    width, p = math.acos(least) * (1 + 1e-9), math.acos(least) / math.pi
    unlike = round(128 * p + 8 * math.sqrt(128 * p * (1 - p)))
    cos = F.when(F.col("node") == F.col("pivot"), 1.0).otherwise(F.coalesce("cos", F.lit(-1.0)))
    near = rest.join(pivots.select(F.col("a").alias("pivot"), F.col("b").alias("node"), "cos"), ["pivot", "node"], "left").withColumn("cos", cos)
    near = near.join(known.groupBy("node").agg(F.first("sketch").alias("sketch"), F.count(F.lit(1)).alias("classes")), "node")
    near = near.select("bucket", "node", "component", "sketch", "classes", F.floor(F.acos(F.greatest(F.least("cos", F.lit(1.0)), F.lit(-1.0))) / width).alias("band"), (F.col("cos") < least).alias("open"))
    left = near.where("open").select("bucket", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("sketch").alias("sa"), F.col("classes").alias("na"), F.col("band").alias("own"), F.explode(F.expr("sequence(band - 1, band)")).alias("band"))
    right = near.select("bucket", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("sketch").alias("sb"), F.col("classes").alias("nb"), "band", F.col("open").alias("open_b"))
    both = left.join(right, ["bucket", "band"]).where("ca <> cb AND (own > band OR NOT open_b OR a < b)")
    both = both.where(f"na > 1 OR nb > 1 OR bit_count(sa[0] ^ sb[0]) + bit_count(sa[1] ^ sb[1]) <= {unlike}")
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


_GROUP = ["component", "i", "si", "j", "sj"]


def _counted(dealt: DataFrame, least: float) -> DataFrame:
    """class_key, n: the weights of the linked vectors of the other side of a group, or of the same if it has one side."""

    def count(rows: list[tuple]) -> tuple[list[bytes], np.ndarray]:
        keys = [r[0] for r in rows]
        left = np.array([r[1] == 0 for r in rows])
        weight = np.array([r[2] for r in rows], np.int64)
        x = np.frombuffer(b"".join(r[3] for r in rows), np.float64).reshape(len(rows), -1)
        out = np.zeros(len(rows), np.int64)
        if left.all():
            linked = x @ x.T >= least
            np.fill_diagonal(linked, False)
            out = linked @ weight
        else:
            linked = x[left] @ x[~left].T >= least
            out[left], out[~left] = linked @ weight[~left], linked.T @ weight[left]
        return keys, out

    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None

        def give() -> pa.RecordBatch:
            keys, n = count(held)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(n, pa.int64())], ["class_key", "n"])

        for b in batches(it, BATCH):
            groups = zip(*(b.column(c).to_pylist() for c in _GROUP), strict=True)
            for group, row in zip(groups, zip(*(b.column(c).to_pylist() for c in ("class_key", "side", "weight", "unit")), strict=True), strict=True):
                if group != now and held:
                    yield give()
                    held = []
                now = group
                held.append(row)
        if held:
            yield give()

    return dealt.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(of, "class_key binary, n long")


def _link_counts(known: DataFrame, component: DataFrame, least: float, chunk: int) -> DataFrame:
    """class_key, n: how many other vectors each class with links is linked to, classes counted by their vectors."""
    whole = F.concat_ws(":", "component", F.length("unit"), "label")  # an id may have vectors of several labels or lengths
    rows = written(known.join(component.withColumnRenamed("id", "node"), "node").select(whole.alias("component"), "node", "class_key", "weight", "unit"), "components")
    sizes = rows.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    large = rows.join(sizes.where(F.col("size") > chunk).select("component"), "component")
    width = math.acos(least) / CELLS
    cell = F.floor(F.acos(F.greatest(F.least("cos", F.lit(1.0)), F.lit(-1.0))) / width)
    placed = rows.drop("node").join(_to_first(large), "class_key", "left").withColumn("cell", F.coalesce(cell, F.lit(0)))
    cells = placed.groupBy("component", "cell").agg(F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("all"))
    cells = cells.join(sizes, "component").select("component", "cell", "all", F.ceil(F.col("rows") / chunk).cast("int").alias("subs"), (F.col("size") > chunk).alias("split"))
    placed = placed.join(cells.select("component", "cell", "subs"), ["component", "cell"]).withColumn("sub", F.pmod(F.xxhash64("class_key"), F.col("subs")).cast("int")).drop("subs")
    cells, placed = written(cells, "cells"), written(placed, "placed")  # short plans for the driver: several branches read both
    i = cells.select("component", "split", F.col("cell").alias("i"), F.col("all").alias("all_i"), F.col("subs").alias("subs_i"))
    j = cells.select("component", F.col("cell").alias("j"), F.col("all").alias("all_j"), F.col("subs").alias("subs_j"))
    sure, never = CELLS - 1e-7, CELLS + 1e-7  # angles in cells
    both = i.join(j, "component").where(f"i <= j AND (NOT split OR j - i - 1 <= {never!r})").withColumn("sure", F.expr(f"split AND i + j + 2 <= {sure!r}"))
    all_of = F.expr("CASE WHEN i = j THEN array(struct(i AS cell, all_i AS n)) ELSE array(struct(i AS cell, all_j AS n), struct(j AS cell, all_i AS n)) END")
    by_cell = both.where("sure").select("component", F.explode(all_of).alias("x"), F.expr("int(i = j)").alias("own"))
    by_cell = by_cell.groupBy("component", "x.cell").agg(F.sum("x.n").alias("n"), F.max("own").alias("own"))
    known_n = placed.join(by_cell, ["component", "cell"]).select("class_key", (F.col("n") - F.col("weight") * F.col("own")).alias("n"))
    pairs = both.where("NOT sure").select("component", "i", "j", F.explode(F.expr("sequence(0, subs_i - 1)")).alias("si"), "subs_j")
    pairs = pairs.select("component", "i", "si", "j", F.explode(F.expr("sequence(0, subs_j - 1)")).alias("sj")).where("i < j OR si <= sj")
    left = placed.join(pairs.withColumns({"cell": F.col("i"), "sub": F.col("si")}), ["component", "cell", "sub"])
    right = placed.join(pairs.where("i < j OR si < sj").withColumns({"cell": F.col("j"), "sub": F.col("sj")}), ["component", "cell", "sub"])
    dealt = left.select(*_GROUP, F.lit(0).alias("side"), "class_key", "weight", "unit").union(right.select(*_GROUP, F.lit(1).alias("side"), "class_key", "weight", "unit"))
    return known_n.union(_counted(dealt, least)).groupBy("class_key").agg(F.sum("n").alias("n"))


def _to_first(rows: DataFrame) -> DataFrame:
    """class_key and the cosine to the first vector of its component, which is sent once for each salt."""

    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, BATCH):
            cos = [float(np.frombuffer(x, np.float64) @ np.frombuffer(y, np.float64)) for x, y in zip(b.column("unit").to_pylist(), b.column("first").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("class_key"), pa.array(cos, pa.float64())], ["class_key", "cos"])

    dealt = rows.select("class_key", "component", "unit", F.pmod(F.xxhash64("class_key"), F.lit(SALTS)).alias("salt"))
    first = rows.groupBy("component").agg(F.min_by("unit", F.struct("node", "class_key")).alias("first"))
    sent = dealt.select("component", "salt").distinct().join(first, "component")
    return dealt.join(sent, ["component", "salt"]).select("class_key", "unit", "first").mapInArrow(of, "class_key binary, cos double")


def near_vectors(
    vectors: DataFrame,
    least: float = LEAST,
    tables: int = TABLES,
    hashes: int = HASHES,
    probes: int = PROBES,
    chunk: int = CHUNK,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept. Vectors of one label are linked from a cosine of `least` on.

    A vector that is null, empty or zero, or holds a null or non-finite component, and one without label or id, is linked
    with nothing; vectors of different lengths are not linked. n_links counts other rows, equal ones too; component_id is the smallest id that
    links lead to. Rows that share an id are one end of links, so their components are one, but each has its own n_links.
    Other columns are ignored; an empty table gives an empty result. With the default tables a pair at the threshold shares no bucket with a
    chance of about 3e-6; every link within a component counts, however it was found. `hashes` should grow with the logarithm
    of the rows of a label: three make 2 million buckets of 64 components.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("vec"))
    all_ = written(_sketches(rows, tables, hashes, probes), "vectors")
    classes = written(all_.where("class_key IS NOT NULL").groupBy("class_key").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight")), "classes")
    one_each = written(all_.withColumnRenamed("vec_id", "node").join(classes, ["class_key", "node"]).dropDuplicates(["class_key"]), "representatives")
    spread = one_each.select("node", F.explode("buckets").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot < last").select("bucket", "pivot")
    members = written(spread.join(shared, "bucket").distinct(), "members")
    several = classes.groupBy("node").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1").select("node")
    some = one_each.select("node", "class_key", "label", "weight", "sketch").join(members.select("node").union(several).distinct(), "node")
    known = written(_units(rows).join(some, ["node", "class_key"]).dropDuplicates(["class_key"]), "units")

    pivots = written(_cosines(members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct(), known), "pivots")
    pivots = pivots.groupBy("a", "b").agg(F.max("cos").alias("cos"))
    ids = all_.where("class_key IS NOT NULL").select("vec_id", "class_key")
    mixed_ids = ids.groupBy("vec_id").agg(F.min("class_key").alias("x"), F.max("class_key").alias("y")).where("x < y").select("vec_id")
    same_id = ids.join(mixed_ids, "vec_id").join(classes, "class_key").where("vec_id <> node").select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    component = connected_components(pivots.where(_linked(least)).select("a", "b").union(same_id))
    placed = members.join(component.withColumnRenamed("id", "node"), "node", "left").select("bucket", "pivot", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("bucket")
    rest = written(placed.join(mixed, "bucket", "left_semi"), "mixed")
    if not rest.isEmpty():
        more = written(_cosines(_open_pairs(rest, pivots, known, least), known).where(_linked(least)), "links")
        if not more.isEmpty():
            component = connected_components(component.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more.select("a", "b")))
    within = component.union(several.join(component, F.col("node") == F.col("id"), "left_anti").select("node", "node"))
    n = written(_link_counts(known, within, least, chunk), "link-counts")
    found = classes.join(component.withColumnRenamed("id", "node"), "node", "left").join(n, "class_key", "left")
    found = found.select("class_key", F.coalesce("component", "node").alias("component_id"), (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"))
    # A third of all rows may be one class: its row is sent once for each salt that its rows have.
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))
    dealt = all_.select("vec_id", "class_key", salt.alias("salt"))
    sent = dealt.where("class_key IS NOT NULL").select("class_key", "salt").distinct().join(found, "class_key")
    component_id = F.coalesce("component_id", "vec_id")
    return dealt.join(sent, ["class_key", "salt"], "left").select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component_id.alias("component_id"), component_id.eqNullSafe(F.col("vec_id")).alias("kept"))


def _linked(least: float) -> Column:
    return F.col("cos") >= least
