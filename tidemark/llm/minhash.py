"""Near duplicates by MinHash: many universal hash minima, banding, signature verification, exact confirmation.

Documents with equal shingle sets are one class and only its representative takes part. Every bucket of a band has a
pivot, its most central member, and the others are compared with it; what is confirmed joins components. Buckets that
then still hold several components are looked at again, by differences from the pivot: what two sets have in common follows from
the items that each lacks or has beyond the pivot, and a pair of different components must share some of these, so a prefix filter on
the rarest of them gives all pairs that could be similar (see _sharing). Sets far from their pivot can only be similar to
other sets that are not close to it; these are compared by signature in small buckets and by a prefix filter on whole sets in large ones.
So no candidate pair that could change a component is left out, and copies of one text that differ too much cost no comparison for
each pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import batches, dealt, free_name, id_text, mix64, split_words, written
from .components import connected_components

BANDS, ROWS = 32, 5
#: A signature's share of equal minima that is refused at a similarity of 0.8 with a chance of about 1e-9.
SIGNATURE_SLACK = 0.2
#: Percent of similarity to the pivot from which differences are used; members of a bucket far from its pivot up to which pairs are compared by signature.
NEAR, SMALL = 50, 32
GROUP = ["pivot", "kind"]
#: Bytes of whole sets in an Arrow batch.
SET_BATCH = 8 << 20


def shingle_sets(text: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the n-word shingles of each text, ascending, and the offsets of the texts in them.

    A text with fewer words gives one shingle, all its words; a text without words gives none.
    """
    words, index, offsets = split_words(text)
    of_word = np.array([xxhash.xxh3_64_intdigest(w) for w in words.cast(pa.binary()).to_pylist()], np.uint64)
    h, size = of_word[index] if len(index) else np.zeros(0, np.uint64), np.diff(offsets)
    shingles = np.maximum(size - n + 1, (size > 0).astype(np.int64))
    ends = np.concatenate([[0], np.cumsum(shingles)])
    doc = np.repeat(np.arange(len(size)), shingles)
    first = offsets[:-1][doc] + np.arange(ends[-1]) - ends[:-1][doc]
    last = offsets[1:][doc]
    out = np.zeros(len(doc), np.uint64)
    for k in range(n):
        at = first + k
        inside = at < last
        step = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[np.where(inside, at, 0)] + np.uint64(k + 1)) if len(h) else out
        out = np.where(inside, step, out)
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    new = np.concatenate([[True], (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])]) if len(out) else np.zeros(0, bool)
    return out[new], np.searchsorted(doc[new], np.arange(len(size) + 1))


def _hashes(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix64(np.arange(1, 2 * count + 1, dtype=np.uint64))
    return seeds[:count] | np.uint64(1), seeds[count:]


def signatures(shingles: np.ndarray, offsets: np.ndarray, count: int) -> np.ndarray:
    """The minima of `count` universal hashes a*x+b (mod 2^64) over each set; sets without a shingle keep the largest value."""
    out = np.full((len(offsets) - 1, count), np.iinfo(np.uint64).max, np.uint64)
    full = np.diff(offsets) > 0
    if full.any():
        for i, (a, b) in enumerate(zip(*_hashes(count), strict=True)):
            out[full, i] = np.minimum.reduceat(shingles * a + b, offsets[:-1][full])
    return out


def _sketches(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 400):
            shingles, offsets = shingle_sets(b.column(1), n)
            minima = signatures(shingles, offsets, bands * rows)
            key = np.zeros((b.num_rows, bands), np.uint64)
            for band in range(bands):
                for row in range(rows):
                    key[:, band] = mix64(key[:, band] * np.uint64(31) + minima[:, band * rows + row] + np.uint64(band))
            wide = -(-minima.shape[1] // 7)
            low = np.zeros((b.num_rows, wide, 8), np.uint8)  # seven bits of a minimum in a byte, seven bytes in a long
            for i in range(minima.shape[1]):
                low[:, i // 7, i % 7] = minima[:, i] & np.uint64(0x7F)
            sketch = pa.ListArray.from_arrays(np.arange(0, b.num_rows * wide + 1, wide, dtype=np.int32), pa.array(low.view("<i8").ravel()))
            data = shingles.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(data[8 * x : 8 * y]) for x, y in zip(offsets, offsets[1:], strict=False)], pa.binary()),
                    pa.ListArray.from_arrays(np.arange(0, key.size + 1, bands, dtype=np.int32), pa.array(key.ravel().view(np.int64))),
                    sketch,
                ],
                ["doc_id", "n_shingles", "set_key", "buckets", "sketch"],
            )

    return docs.mapInArrow(of, "doc_id long, n_shingles long, set_key binary, buckets array<long>, sketch array<long>")


def _sets(docs: DataFrame, n: int) -> DataFrame:
    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 1000):
            shingles, offsets = shingle_sets(b.column("text"), n)
            data = shingles.tobytes()
            sets = pa.array([data[8 * x : 8 * y] for x, y in zip(offsets, offsets[1:], strict=False)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), b.column("sketch"), sets], ["doc_id", "n", "sketch", "shingles"])

    return docs.mapInArrow(of, "doc_id long, n long, sketch array<long>, shingles binary")


def _similar_sketches(hashes: int, percent: int) -> Column:
    """That the sizes n_a and n_b allow the similarity, and that sketch_a and sketch_b agree in as many minima as it leads to."""
    least = percent / 100 - SIGNATURE_SLACK
    sizes = F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    unlike = " + ".join(f"bit_count(((sketch_a[{i}] ^ sketch_b[{i}]) + {0x007F7F7F7F7F7F7F}L) & {0x0080808080808080}L)" for i in range(-(-hashes // 7)))
    return sizes & F.expr(f"{unlike} <= {round((1 - least) * hashes)}")


def _confirmed(pairs: DataFrame, known: DataFrame, percent: int, hashes: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union: refused by size and signature, or else confirmed on full sets."""

    def check(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 50):
            keep = []
            for x, y in zip(b.column("set_a").to_pylist(), b.column("set_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    side = lambda c: known.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"), F.col("shingles").alias(f"set_{c}"))
    pairs, copied = dealt(pairs, "a", "b")  # a pivot has as many pairs as its family has members
    likely = pairs.join(side("b"), "b").join(copied(side("a")), ["a", "deal"]).where(_similar_sketches(hashes, percent))
    return likely.select("a", "b", "set_a", "set_b").mapInArrow(check, "a long, b long")


def _items(sets: DataFrame) -> DataFrame:
    def of(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 100):
            items = [np.frombuffer(x, np.int64) for x in b.column("shingles").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(items, pa.list_(pa.int64()))], ["doc_id", "items"])

    return sets.select("doc_id", "shingles").mapInArrow(of, "doc_id long, items array<long>")


def _members(sketches: DataFrame) -> DataFrame:
    """bucket, doc_id, pivot of all buckets with several members. The pivot is the member that meets most others in all of its
    buckets: the middle of a family of copies is near to more of them than a copy is."""
    buckets = sketches.select("doc_id", F.explode("buckets").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = written(buckets.join(shared, "bucket"), "buckets")
    weight = members.groupBy("doc_id").agg(F.sum("members").alias("weight"))
    pivot = members.join(weight, "doc_id").groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("doc_id")).alias("last"))).alias("most")).select("bucket", (-F.col("most.last")).alias("pivot"))
    return written(members.select("bucket", "doc_id").join(pivot, "bucket"), "members")


def _against_pivot(rest: DataFrame, known: DataFrame, near: int) -> DataFrame:
    """Each set against its pivot's: sizes, how many items they have in common and, with a similarity of at least `near`
    percent, in which items they differ; open says that the two are of different components."""
    keep = ["pivot", "doc_id", "component", "open"]

    def differ(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, 50):
            n, base, common, items = [], [], [], []
            for x, p in zip(b.column("set").to_pylist(), b.column("pivot_set").to_pylist(), strict=True):
                x, p = np.frombuffer(x, np.uint64), np.frombuffer(p, np.uint64)
                unlike = np.setxor1d(x, p, assume_unique=True)
                n.append(len(x))
                base.append(len(p))
                common.append((len(x) + len(p) - len(unlike)) // 2)
                items.append(unlike.view(np.int64) if 100 * common[-1] >= near * (common[-1] + len(unlike)) else None)
            new = [*(pa.array(v, pa.int64()) for v in (n, base, common)), pa.array(items, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *new], [*keep, "n", "base", "common", "items"])

    own = rest.where("doc_id = pivot").select("pivot", F.col("component").alias("of_pivot")).distinct()
    of_pivot = own.join(known.select(F.col("doc_id").alias("pivot"), F.col("shingles").alias("pivot_set")), "pivot")
    members, copied = dealt(rest.select("pivot", "doc_id", "component").distinct(), "pivot", "doc_id")
    both = members.join(known.select("doc_id", F.col("shingles").alias("set")), "doc_id").join(copied(of_pivot), ["pivot", "deal"])
    both = both.select("pivot", "doc_id", "component", (F.col("component") != F.col("of_pivot")).alias("open"), "set", "pivot_set")
    return both.mapInArrow(differ, "pivot long, doc_id long, component long, open boolean, n long, base long, common long, items array<long>")


def _sharing(groups: DataFrame, percent: int) -> DataFrame:
    """Pairs a, b of documents in one group that may be similar, by a prefix filter on the items in which each differs from the
    group's base.

    groups: pivot and kind (the group), doc_id, component, open, n (size of the set), base (size of the base), missing (items of the base that
    the set lacks), items. A pair needs different components and an open document. Two sets have base - missing_a - missing_b
    + (shared items) in common, so a similar pair shares at least `need` items; if need were below 1, both would be similar to the
    base. Hence the first shared item, rarest first, lies among the first size - need + 1 of either.
    """
    whole = lambda n: f"(({percent} * ({n}) + {99 + percent}) div {100 + percent})"  # noqa: E731  the least intersection of sets with n items together
    by_size = f"{whole(f'n + ({percent} * n + 99) div 100')} - base + missing"
    open_ = f"missing + ceil(({percent} * (n - base) + 1) / {100 + percent}.0)"  # the other one is not similar to the base
    any_ = f"missing + ceil(({percent} * n - 100 * base) / {100 + percent}.0)"  # the other one has base - missing items at least
    reach = lambda need: F.expr(f"size - greatest(1, {by_size}, {need}) + 1")
    sized = groups.withColumn("size", F.size("items"))
    sized = sized.select(*GROUP, "doc_id", "component", "open", "n", "base", "missing", "size", "items", reach(open_).alias("to_open"), F.when(F.col("open"), reach(any_)).alias("to_rest"))
    items = sized.withColumn("item", F.explode("items")).drop("items")
    often = items.groupBy(*GROUP, "item").agg(F.count(F.lit(1)).alias("often"))
    ranked = items.join(often, [*GROUP, "item"]).repartition(*GROUP, "doc_id").withColumn("nth", F.row_number().over(W.partitionBy(*GROUP, "doc_id").orderBy("often", "item")))
    ranked = ranked.where("often > 1 AND nth <= greatest(to_open, to_rest)")
    left, right = (ranked.select(*GROUP, "item", *([] if c == "b" else ["base"]), F.col("doc_id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("component", "open", "n", "missing", "size", "nth", "to_open", "to_rest")]) for c in "ab")
    kinds = "CASE WHEN open_b THEN a < b AND nth_a <= to_open_a AND nth_b <= to_open_b ELSE nth_a <= to_rest_a AND nth_b <= to_open_b END"
    alike = f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b) AND least(size_a - nth_a, size_b - nth_b) + 1 >= {whole('n_a + n_b')} - base + missing_a + missing_b"
    on = (left["pivot"] == right["pivot"]) & (left["kind"] == right["kind"]) & (left["item"] == right["item"]) & F.expr(f"component_a <> component_b AND ({kinds}) AND {alike}")
    return left.where("open_a").join(right, on).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _open_pairs(rest: DataFrame, known: DataFrame, percent: int, hashes: int, small: int) -> DataFrame:
    """Of the members of buckets with several components (bucket, pivot, doc_id, component): the pairs a, b of different
    components, neither of them a pivot of the other, that may be similar."""
    against = written(_against_pivot(rest, known, NEAR), "against", SET_BATCH)
    missing = F.col("base") - F.col("common")
    close = against.where("items IS NOT NULL").select("pivot", F.lit(0).alias("kind"), "doc_id", "component", "open", "n", "base", missing.alias("missing"), "items")
    # A set far from the pivot is only similar to sets that are not close to it either: distances obey the triangle inequality.
    far = against.where(f"100 * common < {NEAR + 100 - percent} * (base + n - common)").select("pivot", "doc_id", "n", F.expr(f"100 * common < {NEAR} * (base + n - common)").alias("open"))
    far = rest.join(far, ["pivot", "doc_id"])
    among = far.groupBy("bucket").agg(F.count(F.lit(1)).alias("among"), F.bool_or("open").alias("any")).where("among > 1 AND any").select("bucket", "among")
    far = written(far.join(among, "bucket").join(known.select("doc_id", "sketch"), "doc_id"), "far")
    left, right = (far.where(f"among <= {small}").select("bucket", F.col("doc_id").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("component", "open", "n", "sketch")]) for c in "ab")
    in_bucket = left.join(right, (left["bucket"] == right["bucket"]) & F.expr("a < b AND component_a <> component_b AND (open_a OR open_b)") & _similar_sketches(hashes, percent))
    none = F.lit(0).cast("long")
    crowd = far.where(f"among > {small}").select("pivot", F.lit(1).alias("kind"), "doc_id", "component", "open", "n", none.alias("base"), none.alias("missing")).distinct()
    crowd = crowd.join(_items(known.join(crowd.select("doc_id").distinct(), "doc_id", "left_semi")), "doc_id").select(*close.columns)
    return written(_sharing(close.union(crowd), percent).union(in_bucket.select("a", "b")).distinct(), "pairs")


def near_dedup(docs: DataFrame, shingle_words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, small: int = SMALL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Texts are lower-cased (A-Z) and cut into words [^\\x20\\x09-\\x0D]+. A document with fewer words than a shingle has one
    shingle, all its words; without words or text (null) it has none and is linked with nothing. component_id is the
    smallest id that links lead to, kept says that it is the document's own. Rows that repeat an id have equal results if
    their texts agree. A row with a null id is linked with rows of the same set only. Other columns are ignored; an empty
    table gives an empty result. `small` chooses between two exact ways for documents far from their bucket's pivot.
    """
    docs = id_text(docs, id_col, text_col)
    all_ = written(_sketches(docs, shingle_words, bands, rows), "sketches")
    classes = all_.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    one_each = all_.join(classes.where("rep IS NOT NULL").select("set_key", F.col("rep").alias("doc_id")), ["set_key", "doc_id"], "left_semi").dropDuplicates(["set_key", "doc_id"])
    members = _members(one_each)
    taking_part = members.select("doc_id").distinct().join(one_each.select("doc_id", "sketch"), "doc_id")
    known = written(_sets(docs.join(taking_part, "doc_id").dropDuplicates(["doc_id"]), shingle_words), "sets", SET_BATCH)

    def confirm(pairs: DataFrame) -> DataFrame:
        return written(_confirmed(pairs, known, percent, bands * rows), "links", SET_BATCH)

    component = connected_components(confirm(members.where("doc_id <> pivot").select(F.col("pivot").alias("a"), F.col("doc_id").alias("b")).distinct()))
    placed = members.join(component.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("bucket", "pivot", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("bucket")
    rest = written(placed.join(mixed, "bucket", "left_semi"), "mixed")
    if not rest.isEmpty():
        more = confirm(_open_pairs(rest, known, percent, bands * rows, small))
        if not more.isEmpty():
            component = connected_components(component.select(F.col("id").alias("a"), F.col("component").alias("b")).union(more))
    rep = classes.join(component, F.col("rep") == F.col("id"), "left").select("set_key", F.coalesce("component", "rep").alias("component"))
    return all_.join(rep, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("component", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document, that of the smallest id, left of each component; the columns stay as they are.

    An id stands for a document: rows that share one, a null one too, stay together if any of them is kept. Texts that are
    null or without words are copies of nothing and stay; an empty table gives an empty result.
    """
    name = free_name(docs, "kept_id")
    kept = near_dedup(docs, shingle_words, percent, id_col=id_col, text_col=text_col).where("kept").select(F.col("doc_id").alias(name))
    return docs.join(kept, F.col(id_col).cast("long").eqNullSafe(F.col(name)), "left_semi")
