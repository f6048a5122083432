"""Interval algebra: merge, sort, overlap joins.

Overlap joins are equi-joins on (keys, bin): both sides are spread over fixed bins, and a pair counts in the bin where the later
of the two starts lies, so each pair comes out once without a distinct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BIN, STRETCH = 1 << 10, 1 << 16
#: Nested bins: levels, how many times (a power of 2) the bins of one are wider than those below, and bins of an interval at its own level at most.
LEVELS, GROWTH, FEW = 5, 5, 8


def merge_intervals(intervals: DataFrame, keys: tuple[str, ...] = ("chrom",), gap: int = 0, stretch: int = STRETCH) -> DataFrame:
    """Overlapping and book-ended intervals (or those at most `gap` apart) become one: keys, start, end, n. Rows with a null key or place count for nothing.

    Stretches of a contig are merged by themselves; one row a stretch (where it reaches, where its last island opens) then says
    which of its islands go on with an earlier one.
    """
    keys = list(keys)
    place = [*keys, "stretch"]
    rows = intervals.where("start < `end`").select(*keys, F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))
    rows = rows.withColumn("stretch", F.floor(F.col("start") / stretch)).where(" AND ".join(f"`{k}` IS NOT NULL" for k in place))
    rows = rows.groupBy(*place, "start").agg(F.max("end").alias("end"), F.count(F.lit(1)).alias("n"))
    within = W.partitionBy(*place).orderBy("start")
    before = F.max("end").over(within.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("before", before).withColumn("opens", F.when(F.col("before").isNull() | (F.col("start") > F.col("before") + gap), F.col("start")))
    rows = rows.withColumn("island", F.max("opens").over(within.rowsBetween(W.unboundedPreceding, 0)))
    islands = rows.groupBy(*place, "island").agg(F.max("end").alias("end"), F.sum("n").alias("n"))
    along = W.partitionBy(*keys).orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
    # The total keeps both branches' columns alike, so that the shuffle of one serves the other.
    ends = islands.groupBy(*place).agg(F.max("end").alias("end"), F.max("island").alias("last"), F.sum("n").alias("total")).where("total > 0")
    ends = ends.withColumn("base", F.max("end").over(along))
    ends = ends.withColumn("open", F.max(F.when(F.col("base").isNull() | (F.col("last") > F.col("base") + gap), F.col("last"))).over(along))
    start = F.when(F.col("base").isNull() | (F.col("island") > F.col("base") + gap), F.col("island")).otherwise(F.col("open"))
    both = islands.join(ends.select(*place, "base", "open"), place).select(*keys, start.alias("start"), "end", "n")
    return both.groupBy(*keys, "start").agg(F.max("end").alias("end"), F.sum("n").alias("n"))


def sort_bed(intervals: DataFrame, order: DataFrame | None = None) -> DataFrame:
    """By contig and start; with order (chrom, rank), in the order of a genome file."""
    if order is None:
        return intervals.orderBy("chrom", "start", "end")
    return intervals.join(F.broadcast(order.select("chrom", "rank")), "chrom").orderBy("rank", "start", "end").drop("rank")  # one row for each contig


def _spread(side: DataFrame, prefix: str, keys: list[str], bin_size: int) -> DataFrame:
    """Columns get a prefix; empty intervals go; a row for each bin touched."""
    side = side.where("start < `end`").select(*[F.col(c).alias(f"{prefix}{c}") for c in side.columns])
    first = F.floor(F.col(f"{prefix}start") / bin_size)
    return side.withColumn(f"{prefix}bin", F.explode(F.sequence(first, F.floor((F.col(f"{prefix}end") - 1) / bin_size))))


def overlap_join(a: DataFrame, b: DataFrame, keys: tuple[str, ...] = ("chrom",), bin_size: int = BIN, nested: bool = False) -> DataFrame:
    """Every pair of overlapping intervals once: columns of a as a_*, of b as b_*.

    nested is for tables with intervals of very different lengths: bins of several sizes (see _nested) in place of one.
    """
    keys = list(keys)
    left, right = _nested(a, b, keys, bin_size) if nested else (_spread(a, "a_", keys, bin_size), _spread(b, "b_", keys, bin_size))
    on = F.col("a_bin") == F.col("b_bin")
    for k in keys:
        on &= F.col(f"a_{k}") == F.col(f"b_{k}")
    on &= (F.col("a_start") < F.col("b_end")) & (F.col("b_start") < F.col("a_end"))
    if nested:
        on &= (F.col("a_level") == F.col("b_level")) & (F.col("a_level") == F.greatest("a_own", "b_own"))
        width = F.element_at(F.array(*[F.lit(bin_size << (GROWTH * k)) for k in range(LEVELS)]), F.col("a_level") + 1)
    else:
        width = F.lit(bin_size)
    on &= F.col("a_bin") == F.floor(F.greatest("a_start", "b_start") / width)
    return left.join(right, on).drop("a_bin", "b_bin", "a_level", "b_level", "a_own", "b_own")


def _nested(a: DataFrame, b: DataFrame, keys: list[str], bin_size: int) -> list[DataFrame]:
    """Both sides spread over bins of several sizes. An interval's own level is the finest with at most FEW bins in it; a pair
    meets at the coarser of its two levels. So a row goes to its own level and to those coarser ones that the other side has:
    a whole contig is a handful of rows, and so is a read that lies in one. Which levels a side has is one small row."""
    sides = []
    for side, x in ((a, "a_"), (b, "b_")):
        side = side.where("start < `end`").select(*[F.col(c).alias(f"{x}{c}") for c in side.columns])
        length = F.col(f"{x}end") - F.col(f"{x}start")
        own = F.lit(LEVELS - 1)
        for level in range(LEVELS - 2, -1, -1):
            own = F.when(length <= FEW * (bin_size << (GROWTH * level)), level).otherwise(own)
        sides.append(side.withColumn(f"{x}own", own))
    out = []
    for side, other, x, y in ((sides[0], sides[1], "a_", "b_"), (sides[1], sides[0], "b_", "a_")):
        has = other.agg(F.collect_set(f"{y}own").alias("has"))  # LEVELS numbers at most
        level = F.explode(F.expr(f"array_distinct(transform(has, h -> greatest(h, {x}own)))")).alias(f"{x}level")
        rows = side.crossJoin(F.broadcast(has)).select(*side.columns, level)
        width = F.element_at(F.array(*[F.lit(bin_size << (GROWTH * k)) for k in range(LEVELS)]), F.col(f"{x}level") + 1)
        out.append(rows.withColumn(f"{x}bin", F.explode(F.sequence(F.floor(F.col(f"{x}start") / width), F.floor((F.col(f"{x}end") - 1) / width)))))
    return out


def intersect(a: DataFrame, b: DataFrame, how: str = "each", keys: tuple[str, ...] = ("chrom",), bin_size: int = BIN) -> DataFrame:
    """Rows of a: 'each' once per overlap, 'any' if there is one, 'none' if there is none.

    Rows of equal values are one for 'any' and 'none' in the look-up and stay as many in the result.
    """
    if how == "each":
        pairs = overlap_join(a, b.select(*keys, "start", "end"), keys, bin_size)
        return pairs.select(*[F.col(f"a_{c}").alias(c) for c in a.columns])
    hit = overlap_join(a.select(*keys, "start", "end").distinct(), merge_intervals(b, keys).drop("n"), keys, bin_size)
    hit = hit.select(*[F.col(f"a_{c}").alias(c) for c in (*keys, "start", "end")]).distinct()
    return a.join(hit, [*keys, "start", "end"], "left_semi" if how == "any" else "left_anti").select(*a.columns)


def count_overlaps(a: DataFrame, b: DataFrame, id_col: str, keys: tuple[str, ...] = ("chrom",), bin_size: int = BIN) -> DataFrame:
    """id_col of every row of a, and how many intervals of b overlap it, 0 included."""
    places = b.groupBy(*keys, "start", "end").agg(F.count(F.lit(1)).alias("times"))  # a deep place is one row
    pairs = overlap_join(a.select(id_col, *keys, "start", "end"), places, keys, bin_size)
    found = pairs.groupBy(F.col(f"a_{id_col}").alias(id_col)).agg(F.sum("b_times").alias("n"))
    return a.select(id_col).join(found, id_col, "left").select(id_col, F.coalesce("n", F.lit(0)).alias("n"))


def bed_to_saf(bed: DataFrame) -> DataFrame:
    """gene_id, chrom, start, end, strand: the start stays as it is, the strand is unknown."""
    return bed.select(F.concat_ws(".", "chrom", "start", "end").alias("gene_id"), "chrom", "start", "end", F.lit(".").alias("strand"))
