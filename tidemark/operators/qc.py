"""Quality control: alignment statistics, duplication, strandedness, read distribution, read tables, trimming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import alignment as al

from .intervals import merge_intervals, overlap_join

PRIMARY = al.SECONDARY | al.SUPPLEMENTARY
#: The levels of repetition of a duplication report.
DUPLICATION = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 50, 100, 500, 1000, 5000, 10000)


def flagstat(alignments: DataFrame, keys: tuple[str, ...] = ("sample",), by_quality: bool = False) -> DataFrame:
    """Counts by flag in one pass: keys, then a column for each class; with mate_chrom also the pairs whose mates lie on two contigs.

    by_quality gives two columns for each class, of reads that passed the quality checks of their platform and of those that failed.
    """
    f = F.col("flag")
    first, pair = al.lacks(f, PRIMARY), al.lacks(f, PRIMARY) & al.has(f, al.PAIRED)
    both = pair & al.lacks(f, al.UNMAPPED | al.MATE_UNMAPPED)
    classes = {
        "total": F.lit(True),
        "secondary": al.has(f, al.SECONDARY),
        "supplementary": al.has(f, al.SUPPLEMENTARY),
        "duplicates": al.has(f, al.DUPLICATE),
        "mapped": al.lacks(f, al.UNMAPPED),
        "primary": first,
        "primary_mapped": first & al.lacks(f, al.UNMAPPED),
        "paired": pair,
        "read1": pair & al.has(f, al.FIRST),
        "read2": pair & al.has(f, al.SECOND),
        "properly_paired": pair & al.has(f, al.PROPER) & al.lacks(f, al.UNMAPPED),
        "both_mapped": both,
        "singletons": pair & al.lacks(f, al.UNMAPPED) & al.has(f, al.MATE_UNMAPPED),
        "qc_failed": al.has(f, al.QC_FAIL),
        "primary_duplicates": first & al.has(f, al.DUPLICATE),
    }
    if "mate_chrom" in alignments.columns:
        apart = both & (F.col("mate_chrom") != F.col("chrom"))
        classes |= {"mate_elsewhere": apart, "mate_elsewhere_mapq5": apart & (F.col("mapq") >= 5)}
    if by_quality:
        failed = classes.pop("qc_failed")
        classes = {f"{name}_{which}": c & (failed if which == "failed" else ~failed) for name, c in classes.items() for which in ("passed", "failed")}
    return alignments.groupBy(*keys).agg(*[F.count_if(c).alias(name) for name, c in classes.items()])


def idxstats(alignments: DataFrame, sizes: DataFrame) -> DataFrame:
    """chrom, length, mapped, unmapped of every contig; reads without a contig count under *."""
    by = alignments.groupBy(F.coalesce("chrom", F.lit("*")).alias("chrom")).agg(F.count_if(al.lacks(F.col("flag"), al.UNMAPPED)).alias("mapped"), F.count_if(al.has(F.col("flag"), al.UNMAPPED)).alias("unmapped"))
    all_ = sizes.select("chrom", F.col("length").cast("long").alias("length")).unionByName(sizes.sparkSession.createDataFrame([("*", 0)], "chrom string, length long"))
    return all_.join(by, "chrom", "left").select("chrom", "length", F.coalesce("mapped", F.lit(0)).alias("mapped"), F.coalesce("unmapped", F.lit(0)).alias("unmapped"))


def stats(alignments: DataFrame) -> DataFrame:
    """sample, metric, value: summary numbers of the alignments as a long table."""
    width = F.col("end") - F.col("start")
    mapped = al.lacks(F.col("flag"), al.UNMAPPED)
    wide = alignments.groupBy("sample").agg(
        F.count(F.lit(1)).alias("reads"),
        F.count_if(mapped).alias("reads mapped"),
        F.count_if(al.lacks(F.col("flag"), al.UNMAPPED | PRIMARY) & (F.col("mapq") == 0)).alias("reads of quality 0"),
        F.sum(F.when(mapped, width).otherwise(0)).alias("bases mapped"),
        F.max(width).alias("longest"),
        F.min(width).alias("shortest"),
    )
    names = [c for c in wide.columns if c != "sample"]
    return wide.unpivot("sample", names, "metric", "value").select("sample", "metric", F.col("value").cast("double").alias("value"))


def bam_stat(alignments: DataFrame, quality: int = 30) -> DataFrame:
    """Reads by uniqueness: sample, unmapped, non_primary, non_unique, unique, unique_plus, unique_minus, proper."""
    f = F.col("flag")
    good = al.lacks(f, al.UNMAPPED | PRIMARY | al.QC_FAIL | al.DUPLICATE)
    unique = good & (F.col("mapq") >= quality)
    return alignments.groupBy("sample").agg(
        F.count_if(al.has(f, al.UNMAPPED)).alias("unmapped"),
        F.count_if(~al.lacks(f, PRIMARY) & al.lacks(f, al.UNMAPPED)).alias("non_primary"),
        F.count_if(good & (F.col("mapq") < quality)).alias("non_unique"),
        F.count_if(unique).alias("unique"),
        F.count_if(unique & al.lacks(f, al.REVERSE)).alias("unique_plus"),
        F.count_if(unique & al.has(f, al.REVERSE)).alias("unique_minus"),
        F.count_if(unique & al.has(f, al.PROPER)).alias("proper"),
    )


def duplication(rows: DataFrame, *key: str | Column) -> DataFrame:
    """How many keys occur so many times: occurrence, n."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrence")).groupBy("occurrence").agg(F.count(F.lit(1)).alias("n"))


def infer_experiment(reads: DataFrame, genes: DataFrame, paired: bool = False) -> DataFrame:
    """Share of the reads of each sample by their strand and the strand of the genes they overlap: sample, class, n, fraction.

    A read over genes of both strands is undetermined; reads over no gene are left out. paired puts the mate's number, 1 or 2 by
    the flag, before the strands. Reads of one place fare alike, so each place is looked up once.
    """
    mate = F.when(al.has(F.col("flag"), al.FIRST), "1").otherwise("2") if paired else F.lit("")
    kinds = reads.withColumn("mate", mate).groupBy("sample", "chrom", "start", "end", "strand", "mate").agg(F.count(F.lit(1)).alias("times"))
    pairs = overlap_join(kinds.select("chrom", "start", "end").distinct(), genes.select("chrom", "start", "end", "strand"))
    over = pairs.groupBy(*[F.col(f"a_{c}").alias(c) for c in ("chrom", "start", "end")]).agg(F.min("b_strand").alias("low"), F.max("b_strand").alias("high"))
    of_place = kinds.join(over, ["chrom", "start", "end"])
    named = of_place.select("sample", "times", F.when(F.col("low") != F.col("high"), "undetermined").otherwise(F.concat("mate", "strand", "low")).alias("class"))
    counts = named.groupBy("sample", "class").agg(F.sum("times").alias("n"))
    total = counts.groupBy("sample").agg(F.sum("n").alias("total"))
    return counts.join(total, "sample").select("sample", "class", "n", F.round(F.col("n") / F.col("total"), 6).alias("fraction"))


def read_distribution(reads: DataFrame, regions: DataFrame) -> DataFrame:
    """Reads by the region class of the smallest priority that their middle lies in, or intergenic: class, n.

    regions: chrom, start, end, class, priority.
    """
    middle = F.floor((F.col("start") + F.col("end")) / 2)
    points = reads.select("id", "chrom", middle.alias("start"), (middle + 1).alias("end"))
    hits = overlap_join(points, regions).groupBy("a_id").agg(F.min_by("b_class", "b_priority").alias("class"))
    return points.join(hits, points["id"] == hits["a_id"], "left").groupBy(F.coalesce("class", F.lit("intergenic")).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def inner_distance(pairs: DataFrame, low: int = -250, high: int = 250, step: int = 5) -> DataFrame:
    """Histogram of the gap between two mates: bin (lower end), n; beyond the ends is left out."""
    gap = F.col("mate_start") - F.col("end")
    return pairs.where(gap.between(low, high - 1)).groupBy((F.floor((gap - low) / step) * step + low).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def inner_distance_stats(pairs: DataFrame) -> DataFrame:
    """sample, n, mean, median, sd of the gap between two mates."""
    gap = F.col("mate_start") - F.col("end")
    of = pairs.where(gap.isNotNull()).groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.avg(gap).alias("mean"), F.median(gap).alias("median"), F.stddev_samp(gap).alias("sd"))
    return of.select("sample", "n", *[F.round(c, 6).alias(c) for c in ("mean", "median", "sd")])


def junctions(introns: DataFrame, known: DataFrame) -> DataFrame:
    """Splice junctions by class: chrom, start, end, reads, class (annotated, partial_novel, complete_novel)."""
    seen = introns.groupBy("chrom", "start", "end").agg(F.count(F.lit(1)).alias("reads"))
    whole = known.select("chrom", "start", "end", F.lit(True).alias("whole")).distinct()
    left, right = known.select("chrom", "start", F.lit(True).alias("left")).distinct(), known.select("chrom", "end", F.lit(True).alias("right")).distinct()
    seen = seen.join(whole, ["chrom", "start", "end"], "left").join(left, ["chrom", "start"], "left").join(right, ["chrom", "end"], "left")
    return seen.select("chrom", "start", "end", "reads", F.when(F.col("whole"), "annotated").when(F.coalesce("left", "right"), "partial_novel").otherwise("complete_novel").alias("class"))


def junction_saturation(introns: DataFrame, known: DataFrame, deal: Column, step: int = 5, least: int = 1) -> DataFrame:
    """Junctions seen with at least `least` reads among growing shares of the reads: percent, known, novel.

    deal: a number from 0 to 99 for each read, which says from which percent on it counts. One pass serves all shares.
    """
    place = ["chrom", "start", "end"]
    from_ = ((F.floor(deal / step) + 1) * step).cast("long")
    n = introns.groupBy(*place, from_.alias("percent")).agg(F.count(F.lit(1)).alias("n"))  # a row at most for each share
    so_far = F.sum("n").over(W.partitionBy(*place).orderBy("percent").rowsBetween(W.unboundedPreceding, 0))
    first = n.withColumn("n", so_far).where(F.col("n") >= least).groupBy(*place).agg(F.min("percent").alias("percent"))
    named = first.join(known.select(*place, F.lit(True).alias("known")).distinct(), place, "left")
    by = named.groupBy("percent").agg(F.count_if("known").alias("known"), F.count_if(F.col("known").isNull()).alias("novel"))
    shares = introns.sparkSession.range(step, 101, step).select(F.col("id").alias("percent"))
    upto = W.orderBy("percent").rowsBetween(W.unboundedPreceding, 0)  # 100 / step rows
    return shares.join(by, "percent", "left").select("percent", *[F.sum(F.coalesce(c, F.lit(0))).over(upto).alias(c) for c in ("known", "novel")])


def transcript_integrity(depth: DataFrame, exons: DataFrame) -> DataFrame:
    """transcript, length, bases, tin: 100 times the exponential of the entropy of a transcript's depth, by its length; 0 without reads.

    depth: runs of equal depth (chrom, start, end, depth); exons: transcript, chrom, start, end, of which overlapping ones count once.
    All positions count, not a sample of them.
    """
    parts = merge_intervals(exons, ("transcript", "chrom"))
    length = parts.groupBy("transcript").agg(F.sum(F.col("end") - F.col("start")).alias("length"))
    pairs = overlap_join(parts.select("transcript", "chrom", "start", "end"), depth.select("chrom", "start", "end", "depth"))
    width = F.least("a_end", "b_end") - F.greatest("a_start", "b_start")
    sums = pairs.groupBy(F.col("a_transcript").alias("transcript")).agg(F.sum(width * F.col("b_depth")).alias("bases"), F.sum(width * F.col("b_depth") * F.log("b_depth")).alias("logs"))
    tin = 100 * F.exp(F.log("bases") - F.col("logs") / F.col("bases")) / F.col("length")
    return length.join(sums, "transcript", "left").select("transcript", "length", F.coalesce("bases", F.lit(0)).alias("bases"), F.round(F.coalesce(tin, F.lit(0.0)), 6).alias("tin"))


def histograms(alignments: DataFrame) -> DataFrame:
    """sample, section, value, n in one pass: read lengths, mapping qualities, and insert sizes of first mates in proper pairs on one contig."""
    f = F.col("flag")
    insert = F.when(al.has(f, al.PROPER) & al.has(f, al.FIRST) & (F.col("mate_chrom") == F.col("chrom")), F.greatest("end", "mate_end") - F.least("start", "mate_start"))
    sections = {"read_length": F.col("end") - F.col("start"), "mapq": F.col("mapq"), "insert_size": insert}
    each = F.array(*[F.struct(F.lit(name).alias("section"), value.cast("long").alias("value")) for name, value in sections.items()])
    rows = alignments.where(al.lacks(f, al.UNMAPPED | PRIMARY)).select("sample", F.explode(each).alias("e")).where("e.value IS NOT NULL")
    return rows.groupBy("sample", "e.section", "e.value").agg(F.count(F.lit(1)).alias("n"))


def per_base(reads: DataFrame, seq: str = "seq") -> DataFrame:
    """Characters by position: pos (from 0), base, n."""
    chars = reads.select(F.posexplode(F.split(F.col(seq), "")).alias("pos", "base")).where("base <> ''")
    return chars.groupBy("pos", "base").agg(F.count(F.lit(1)).alias("n"))


def per_base_quality(reads: DataFrame, qual: str = "qual") -> DataFrame:
    """Mean and quartiles of the quality by position: pos, mean, q1, median, q3."""
    rows = reads.select(F.posexplode(F.split(F.col(qual), "")).alias("pos", "c")).where("c <> ''").select("pos", (F.ascii("c") - 33).alias("q"))
    return rows.groupBy("pos").agg(F.avg("q").alias("mean"), *[F.percentile("q", p).alias(n) for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3"))])


def length_histogram(reads: DataFrame, seq: str = "seq") -> DataFrame:
    """length, n."""
    return reads.groupBy(F.length(seq).cast("long").alias("length")).agg(F.count(F.lit(1)).alias("n"))


def gc_histogram(reads: DataFrame, seq: str = "seq") -> DataFrame:
    """Whole percent of G and C, n."""
    gc = F.length(F.regexp_replace(F.upper(F.col(seq)), "[^GC]", ""))
    return reads.where(F.length(seq) > 0).groupBy(F.round(100 * gc / F.length(seq)).cast("long").alias("gc")).agg(F.count(F.lit(1)).alias("n"))


def overrepresented(reads: DataFrame, least_percent: float = 0.1, seq: str = "seq", first: int | None = None) -> DataFrame:
    """Sequences that make up at least such a share: seq, n, percent. With `first`, they are told apart by so many characters."""
    counts = reads.groupBy((F.substring(seq, 1, first) if first else F.col(seq)).alias("seq")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # one row
    return counts.crossJoin(F.broadcast(total)).select("seq", "n", F.round(100 * F.col("n") / F.col("total"), 6).alias("percent")).where(F.col("percent") >= least_percent)


def duplication_levels(reads: DataFrame, seq: str = "seq") -> DataFrame:
    """How much of the reads sequences of each level of repetition make up: level (least number of copies), sequences, reads, percent."""
    counts = reads.groupBy(F.col(seq)).agg(F.count(F.lit(1)).alias("n"))
    level = F.lit(DUPLICATION[0])
    for least in DUPLICATION[1:]:
        level = F.when(F.col("n") >= least, least).otherwise(level)
    levels = counts.groupBy(level.cast("long").alias("level")).agg(F.count(F.lit(1)).alias("sequences"), F.sum("n").alias("reads"))
    total = levels.agg(F.sum("reads").alias("total"))  # one row, as levels are few
    return levels.crossJoin(F.broadcast(total)).select("level", "sequences", "reads", F.round(100 * F.col("reads") / F.col("total"), 6).alias("percent"))


def adapter_content(reads: DataFrame, adapters: dict[str, str], seq: str = "seq") -> DataFrame:
    """Where adapters begin first: adapter (its name), pos (from 0), n, and reached, the percent of reads that hold it there or before."""
    at = F.array(*[F.struct(F.lit(name).alias("adapter"), F.locate(letters, F.col(seq)).alias("at")) for name, letters in adapters.items()])
    found = reads.select(F.explode(at).alias("x")).where("x.at > 0").groupBy("x.adapter", (F.col("x.at") - 1).cast("long").alias("pos")).agg(F.count(F.lit(1)).alias("n"))
    total = reads.agg(F.count(F.lit(1)).alias("total"))  # one row
    along = W.partitionBy("adapter").orderBy("pos")  # a row for each position
    return found.crossJoin(F.broadcast(total)).select("adapter", "pos", "n", F.round(100 * F.sum("n").over(along) / F.col("total"), 6).alias("reached"))


def trim_quality(reads: DataFrame, least: int = 20, window: int = 4, seq: str = "seq", qual: str = "qual") -> DataFrame:
    """Reads cut where the mean quality of `window` bases first falls below `least`; a read shorter than a window stays whole."""
    score = F.transform(F.filter(F.split(F.col(qual), ""), lambda c: c != ""), lambda c: F.ascii(c) - 33)
    sums = lambda i: F.aggregate(F.slice(F.col("_q"), i, window), F.lit(0), lambda a, b: a + b)
    rows = reads.withColumn("_q", score).withColumn("_cut", F.when(F.size("_q") >= window, F.filter(F.sequence(F.lit(1), F.size("_q") - window + 1), lambda i: sums(i) < least * window)))
    end = F.when(F.size("_cut") > 0, F.element_at("_cut", 1) - 1).otherwise(F.length(qual))
    return rows.withColumn("_end", end).withColumn(seq, F.col(seq).substr(F.lit(1), F.col("_end"))).withColumn(qual, F.col(qual).substr(F.lit(1), F.col("_end"))).select(*reads.columns)


def trim(reads: DataFrame, adapter: str | None = None, head: int = 0, tail: int = 0, poly: str | None = None, least: int = 15, complexity: float | None = None, umi: int = 0, seq: str = "seq", name: str = "name") -> DataFrame:
    """Trimmed and filtered reads: a UMI moves to the name, ends and adapter go, then short and simple reads.

    poly is a letter whose runs of 10 or more go from the end; complexity is the least share of letters that differ from the next.
    """
    s = F.col(seq)
    out = reads
    if umi:
        out = out.withColumn(name, F.concat_ws("_", name, F.substring(s, 1, umi))).withColumn(seq, s.substr(F.lit(umi + 1), F.length(s)))
    out = out.withColumn(seq, s.substr(F.lit(head + 1), F.greatest(F.length(s) - head - tail, F.lit(0))))
    if adapter:
        at = F.locate(adapter, s)
        out = out.withColumn(seq, F.when(at > 0, s.substr(F.lit(1), at - 1)).otherwise(s))
    if poly:
        out = out.withColumn(seq, F.regexp_replace(s, f"{poly}{{10,}}$", ""))
    out = out.where(F.length(s) >= least)
    if complexity is not None:
        chars = F.split(s, "")
        unlike = F.size(F.filter(F.arrays_zip(chars.alias("a"), F.slice(chars, F.lit(2), F.greatest(F.size(chars) - 1, F.lit(0))).alias("b")), lambda z: z["b"].isNotNull() & (z["b"] != "") & (z["a"] != z["b"])))
        out = out.where(unlike >= complexity * (F.length(s) - 1))
    return out


def metrics_table(*tables: DataFrame) -> DataFrame:
    """Long tables (sample, metric, value) of several tools side by side: a row per sample, a column per metric."""
    from .samples import mix

    long = mix(*tables)
    return long.groupBy("sample").pivot("metric").agg(F.first("value"))
