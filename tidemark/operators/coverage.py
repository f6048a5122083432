"""Depth of coverage by sweep line.

Prefix sums run in two levels: within stretches of a contig, and over the totals of stretches. A contig's size therefore
bounds no task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

STRETCH = 1 << 16


def coverage(intervals: DataFrame, keys: tuple[str, ...] = ("chrom",), scale: float | None = None, stretch: int = STRETCH) -> DataFrame:
    """Maximal runs of equal, nonzero depth: keys, start, end, depth (times scale). Empty intervals and nulls count for nothing."""
    keys = list(keys)
    ends = intervals.where("start < `end`").select(*keys, F.explode(F.array(F.struct(F.col("start").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("end").alias("pos"), F.lit(-1).alias("d")))).alias("e"))
    events = ends.select(*keys, F.col("e.pos").cast("long").alias("pos"), "e.d").withColumn("stretch", F.floor(F.col("pos") / stretch))
    # Both branches below need rows without nulls: said here, the shuffle of one serves the other.
    events = events.where(" AND ".join(f"`{k}` IS NOT NULL" for k in [*keys, "stretch"]))
    events = events.groupBy(*keys, "stretch", "pos").agg(F.sum("d").alias("d")).where("d <> 0")
    along = W.partitionBy(*keys).orderBy("stretch")
    totals = events.groupBy(*keys, "stretch").agg(F.sum("d").alias("d"), F.min("pos").alias("first"))
    totals = totals.select(*keys, "stretch", F.coalesce(F.sum("d").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"), F.lead("first").over(along).alias("next"))
    within = W.partitionBy(*keys, "stretch").orderBy("pos")
    runs = events.join(totals, [*keys, "stretch"]).select(*keys, F.col("pos").alias("start"), F.coalesce(F.lead("pos").over(within), "next").alias("end"), (F.col("base") + F.sum("d").over(within)).alias("depth")).where("depth <> 0")
    return runs if scale is None else runs.withColumn("depth", F.col("depth") * F.lit(float(scale)))


def binned(intervals: DataFrame, size: int = 50, keys: tuple[str, ...] = ("chrom", "strand")) -> DataFrame:
    """Reads by the fixed bin of their start: keys, bin, n."""
    return intervals.groupBy(*keys, F.floor(F.col("start") / size).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def mean_depth(intervals: DataFrame, size: int = 50, keys: tuple[str, ...] = ("chrom",)) -> DataFrame:
    """Mean depth of each touched bin: keys, bin, depth."""
    cut = intervals.where("start < `end`").select(*keys, "start", "end", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size))).alias("bin"))
    part = F.least("end", (F.col("bin") + 1) * size) - F.greatest("start", F.col("bin") * size)
    return cut.groupBy(*keys, "bin").agg((F.sum(part) / size).alias("depth"))


def signed(plus_minus: DataFrame) -> DataFrame:
    """Depth of the minus strand below zero."""
    return plus_minus.withColumn("depth", F.when(F.col("strand") == "-", -F.col("depth")).otherwise(F.col("depth")))


def per_contig(depth: DataFrame, sizes: DataFrame) -> DataFrame:
    """chrom, length, covered, covered_percent, mean_depth, sd_depth over whole contigs, from depth runs."""
    width = F.col("end") - F.col("start")
    sums = depth.groupBy("chrom").agg(F.sum(width).alias("covered"), F.sum(width * F.col("depth")).alias("s"), F.sum(width * F.col("depth") * F.col("depth")).alias("ss"))
    mean = F.coalesce("s", F.lit(0)) / F.col("length")
    return sizes.join(sums, "chrom", "left").select(
        "chrom",
        "length",
        F.coalesce("covered", F.lit(0)).alias("covered"),
        F.round(100 * F.coalesce("covered", F.lit(0)) / F.col("length"), 6).alias("covered_percent"),
        F.round(mean, 6).alias("mean_depth"),
        F.round(F.sqrt(F.greatest(F.coalesce("ss", F.lit(0)) / F.col("length") - mean * mean, F.lit(0.0))), 6).alias("sd_depth"),
    )


def median_depth(depth: DataFrame, sizes: DataFrame) -> DataFrame:
    """chrom, median_depth: the smallest depth that at least half of a contig's bases do not exceed, uncovered ones included."""
    covered = depth.groupBy("chrom", "depth").agg(F.sum(F.col("end") - F.col("start")).alias("bases"))
    bare = sizes.join(covered.groupBy("chrom").agg(F.sum("bases").alias("bases")), "chrom", "left")
    bare = bare.select("chrom", F.lit(0).cast("long").alias("depth"), (F.col("length") - F.coalesce("bases", F.lit(0))).alias("bases"))
    upto = W.partitionBy("chrom").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)  # a row for each depth that occurs
    sums = bare.unionByName(covered).withColumn("upto", F.sum("bases").over(upto)).join(sizes, "chrom")
    return sums.where(2 * F.col("upto") >= F.col("length")).groupBy("chrom").agg(F.min("depth").alias("median_depth"))


def strand_reads(reads: DataFrame, sizes: DataFrame) -> DataFrame:
    """chrom, plus_reads, minus_reads of every contig, 0 included."""
    n = reads.groupBy("chrom").agg(F.count_if(F.col("strand") == "+").alias("plus_reads"), F.count_if(F.col("strand") == "-").alias("minus_reads"))
    return sizes.select("chrom").join(n, "chrom", "left").fillna(0, ["plus_reads", "minus_reads"])


def depth_histogram(depth: DataFrame) -> DataFrame:
    """depth, bases."""
    return depth.groupBy("depth").agg(F.sum(F.col("end") - F.col("start")).alias("bases"))
