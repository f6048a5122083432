"""Transcript calling: parameter grids, segmentation, evaluation against an annotation, repair, peaks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import alignment as al
from tidemark.functions.laws import poisson_tail

from .hmm import active_stretches, hmm_grid, hmm_transcripts  # noqa: F401  hmm_transcripts is offered here too
from .intervals import STRETCH, count_overlaps, merge_intervals, overlap_join


#: Decimal places of reported chances: ranks and the cut go by these, so that they do not hang on a last bit.
P_DIGITS = 9


def grid(spark: SparkSession, uts: tuple[int, int, int] = (5, 45, 5), ltprobb: tuple[int, int, int] = (-100, -400, -50)) -> DataFrame:
    """All pairs of two ranges (first, last, step): LtProbB, UTS, row_no in file order."""
    a = spark.range(1).select(F.explode(F.sequence(F.lit(ltprobb[0]), F.lit(ltprobb[1]), F.lit(ltprobb[2]))).alias("LtProbB"))
    b = spark.range(1).select(F.explode(F.sequence(F.lit(uts[0]), F.lit(uts[1]), F.lit(uts[2]))).alias("UTS"))
    steps = (uts[1] - uts[0]) // uts[2] + 1
    return a.crossJoin(b).withColumn("row_no", ((F.col("LtProbB") - ltprobb[0]) / ltprobb[2] * steps + (F.col("UTS") - uts[0]) / uts[2]).cast("long"))


def evaluate(calls: DataFrame, genes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """merged, dissociated, total, error_rate, tx_size of calls (id, chrom, strand, start, end) against genes (gene, ...), a row for each value of `by`.

    A call over several genes is merged; a gene under n calls counts n - 1 dissociated; error_rate is total by genes and calls,
    tx_size the number of calls.
    """
    keys = ("chrom", "strand")
    pairs = overlap_join(calls.select(*by, "id", *keys, "start", "end"), genes.select("gene", *keys, "start", "end"), keys)
    pairs = pairs.select(*[F.col(f"a_{c}").alias(c) for c in by], F.col("a_id").alias("id"), F.col("b_gene").alias("gene")).distinct()
    merged = pairs.groupBy(*by, "id").count().groupBy(*by).agg(F.count_if(F.col("count") > 1).alias("merged"))
    apart = pairs.groupBy(*by, "gene").count().groupBy(*by).agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("dissociated"))
    sizes = calls.groupBy(*by).agg(F.count(F.lit(1)).alias("tx_size"))
    n = genes.agg(F.count(F.lit(1)).alias("genes"))  # one row
    both = sizes.join(merged, list(by), "left").join(apart, list(by), "left") if by else sizes.crossJoin(merged).crossJoin(apart)
    both = both.fillna(0, ["merged", "dissociated"]).crossJoin(F.broadcast(n)).withColumn("total", F.col("merged") + F.col("dissociated"))
    return both.select(*by, "merged", "dissociated", "total", error_rate(F.col("total"), F.col("tx_size"), F.col("genes")).alias("error_rate"), "tx_size")


def error_rate(total: Column, calls: Column, genes: Column) -> Column:
    return F.round(total / (calls + genes), 6)


def tune(counts: DataFrame, genes: DataFrame, params: DataFrame, size: int = 50, gap: int = 200, keys: tuple[str, ...] = ("chrom", "strand")) -> DataFrame:
    """Every pair of parameters (LtProbB, UTS, row_no) with the errors of the transcripts that it calls; a pair without calls has no error rate."""
    calls = hmm_grid(counts, params, size, gap, keys).withColumn("id", F.concat_ws(":", *keys, "start"))
    return params.join(evaluate(calls, genes, ("row_no",)), "row_no", "left")


def expressed(features: DataFrame, reads: DataFrame, size: int = 1000, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Features with a read in their first `size` bases, whose width lies strictly between two quantiles of such features' widths."""
    front = features.withColumn("_c", al.clip_to(F.col("start"), F.col("end"), F.col("strand"), size)).select("gene", "chrom", F.col("_c.start").alias("start"), F.col("_c.end").alias("end"))
    seen = features.join(count_overlaps(front, reads, "gene").where("n > 0").select("gene"), "gene", "left_semi").withColumn("width", F.col("end") - F.col("start"))
    band = seen.agg(F.percentile("width", low).alias("low"), F.percentile("width", high).alias("high"))
    return seen.crossJoin(F.broadcast(band)).where("width > low AND width < high").select(*features.columns, "width")  # one row


def break_on_genes(calls: DataFrame, genes: DataFrame) -> DataFrame:
    """Calls over several genes of their strand are cut where the next gene starts: id, chrom, strand, start, end, part."""
    keys = ("chrom", "strand")
    pairs = overlap_join(calls.select("id", *keys, "start", "end"), genes.select("gene", *keys, "start", "end"), keys)
    inner = pairs.where("b_start > a_start").select(F.col("a_id").alias("id"), F.col("b_start").alias("at")).distinct()
    over = pairs.groupBy(F.col("a_id").alias("id")).agg(F.min("b_start").alias("first"))
    cuts = inner.join(over, "id").where("at > first").select("id", "at")
    edges = calls.select("id", F.col("start").alias("at")).unionByName(cuts).distinct()
    w = W.partitionBy("id").orderBy("at")
    return edges.join(calls, "id").select("id", *keys, F.col("at").alias("start"), F.coalesce(F.lead("at").over(w), "end").alias("end"), F.row_number().over(w).alias("part"))


def combine_by_gene(parts: DataFrame, genes: DataFrame) -> DataFrame:
    """Parts over the same gene become one; parts over none stay: chrom, strand, start, end, n."""
    keys = ("chrom", "strand")
    rows = parts.withColumn("part_id", F.concat_ws(".", "id", "part"))
    pairs = overlap_join(rows.select("part_id", *keys, "start", "end"), genes.select("gene", *keys, "start", "end"), keys)
    of = pairs.groupBy(F.col("a_part_id").alias("part_id")).agg(F.min_by("b_gene", F.struct("b_start", "b_gene")).alias("gene"))
    joined = rows.join(of, "part_id", "left").withColumn("group", F.coalesce(F.concat(F.lit("g"), F.col("gene")), F.concat(F.lit("p"), F.col("part_id"))))
    return joined.groupBy(*keys, "group").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n")).drop("group")


def density(reads: DataFrame, features: DataFrame, bins: int = 100) -> DataFrame:
    """Reads by their relative place in features of their strand: bin (from the 5' end), n, per_feature."""
    keys = ("chrom", "strand")
    first = al.last_base(F.col("start"), F.col("end"), F.col("strand"))
    points = reads.select(*keys, first["start"].alias("start"), first["end"].alias("end"))
    pairs = overlap_join(points, features.select("gene", *keys, "start", "end"), keys)
    at = F.when(F.col("a_strand") == "-", F.col("b_end") - 1 - F.col("a_start")).otherwise(F.col("a_start") - F.col("b_start"))
    counts = pairs.groupBy(F.floor(at * bins / (F.col("b_end") - F.col("b_start"))).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    total = features.agg(F.count(F.lit(1)).alias("features"))
    return counts.crossJoin(F.broadcast(total)).select("bin", "n", F.round(F.col("n") / F.col("features"), 6).alias("per_feature"))  # one row


def dense_transcripts(counts: DataFrame, size: int = 50, start_fold: float = 4.0, body_fold: float = 3.0, least: int = 600, most: int = 10_000, window: int = 5, gap: int = 200, keys: tuple[str, ...] = ("chrom", "strand")) -> DataFrame:
    """Transcripts by density: one starts where the mean over a window is start_fold times the background, ends where it falls below
    background / body_fold, and a new one starts on a lasting rise by body_fold. Shorter ones than `least` bases go; a body's level is
    judged on `most` bases at most. keys, start, end, reads."""
    background = float(counts.agg(F.avg("n")).first()[0] or 1.0)  # one number
    names = counts.select(*keys).dtypes

    def call(pdf: pd.DataFrame) -> pd.DataFrame:
        low = int(pdf["bin"].min())
        n = np.zeros(int(pdf["bin"].max()) - low + 1)
        n[pdf["bin"].to_numpy() - low] = pdf["n"]
        level = np.convolve(n, np.ones(window) / window, "same") if len(n) >= window else np.full(len(n), n.mean())
        out, start = [], None
        for i, x in enumerate(level):
            if start is None:
                start = i if x >= start_fold * background / window else None
                continue
            body = n[max(start, i - most // size) : i].mean() if i > start else x
            if x < background / body_fold / window:
                out.append((start, i))
                start = None
            elif i - start >= window and x > body_fold * max(body, 1e-9) and level[i : i + window].mean() > body_fold * body:
                out.append((start, i))
                start = i
        if start is not None:
            out.append((start, len(n)))
        rows = [[*(pdf[k].iloc[0] for k in keys), (low + a) * size, (low + b) * size, int(n[a:b].sum())] for a, b in out if (b - a) * size >= least]
        return pd.DataFrame(rows, columns=[*keys, "start", "end", "reads"])

    schema = ", ".join(f"{c} {t}" for c, t in names) + ", start long, end long, reads long"
    return active_stretches(counts, keys, gap).groupBy(*keys, "stretch").applyInPandas(call, schema)


def on_contigs(rows: DataFrame, prefixes: tuple[str, ...]) -> DataFrame:
    """Rows of contigs whose name starts with one of the prefixes."""
    hit = F.lit(False)
    for p in prefixes:
        hit |= F.col("chrom").startswith(p)
    return rows.where(hit)


def gather_peaks(peaks: DataFrame, gap: int = 0) -> DataFrame:
    """Start sites (chrom, pos) of all contigs and strands, those at most `gap` bases apart as one: chrom, start, end, n (sites)."""
    return merge_intervals(peaks.select("chrom", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end")), gap=gap)


def tss_peaks(ends: DataFrame, reach: int = 100, false_rate: float = 0.1, pair_distance: int = 300, inflated: bool = False) -> DataFrame:
    """Start sites from 5'-end counts (chrom, strand, pos, n): positions far above the mean of their surroundings (Poisson tail, corrected
    after Benjamini and Hochberg). chrom, strand, pos, n, p, kind: divergent if a peak of the other strand is near, else unidirectional.

    inflated takes the surroundings for a Poisson law with too many zeros, fitted by its moments: the rate is that of the
    positions in use, so sparse but busy surroundings give fewer peaks (the positions tested are in use themselves).

    Surroundings are summed by blocks of positions with copies of what lies within `reach` of their edges, ranks by buckets of p."""
    block = max(STRETCH, reach)
    own = F.floor(F.col("pos") / block)
    spread = ends.select("chrom", "strand", "pos", "n", own.alias("own"), F.explode(F.sequence(F.floor((F.col("pos") - reach) / block), F.floor((F.col("pos") + reach) / block))).alias("block"))
    w = W.partitionBy("chrom", "strand", "block").orderBy("pos").rangeBetween(-reach, reach)
    mean = (F.sum("n").over(w) - F.col("n")) / F.lit(2.0 * reach)
    local = spread.withColumn("mean", mean).withColumn("rate", F.greatest("mean", F.lit(1.0 / reach)))
    if inflated:
        squares = (F.sum(F.col("n") * F.col("n")).over(w) - F.col("n") * F.col("n")) / F.lit(2.0 * reach)
        local = local.withColumn("squares", squares).withColumn("rate", F.greatest("rate", F.when(F.col("mean") > 0, F.col("squares") / F.col("mean") - 1)))
    local = local.where("block = own")

    def test(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pdf.assign(p=np.round(np.maximum(poisson_tail(pdf["n"].to_numpy(), pdf["rate"].to_numpy()), 1e-300), P_DIGITS))[["chrom", "strand", "pos", "n", "p"]]

    tested = local.select("chrom", "strand", "pos", "n", "rate").mapInPandas(test, "chrom string, strand string, pos long, n long, p double")
    levels = tested.groupBy("p").agg(F.count(F.lit(1)).alias("m")).withColumn("bucket", F.floor(F.col("p") * 4096))
    buckets = levels.groupBy("bucket").agg(F.sum("m").alias("m"))  # 4,097 rows at most
    before = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    every = W.orderBy("bucket").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    buckets = buckets.select("bucket", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"), F.sum("m").over(every).alias("total"))
    within = W.partitionBy("bucket").orderBy("p").rowsBetween(W.unboundedPreceding, 0)
    ranked = levels.join(F.broadcast(buckets), "bucket").withColumn("rank", F.col("base") + F.sum("m").over(within))
    limit = ranked.where(F.col("p") <= false_rate * F.col("rank") / F.col("total")).agg(F.max("p").alias("limit"))
    peaks = tested.crossJoin(F.broadcast(limit)).where("p <= limit").drop("limit")
    around = peaks.select("chrom", F.translate("strand", "+-", "-+").alias("strand"), (F.col("pos") - pair_distance).alias("start"), (F.col("pos") + pair_distance + 1).alias("end"))
    points = peaks.select("chrom", "strand", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"))
    near = overlap_join(points, around, ("chrom", "strand")).select(F.col("a_chrom").alias("chrom"), F.col("a_strand").alias("strand"), F.col("a_start").alias("pos")).distinct().withColumn("near", F.lit(True))
    return peaks.join(near, ["chrom", "strand", "pos"], "left").select("chrom", "strand", "pos", "n", "p", F.when(F.col("near"), "divergent").otherwise("unidirectional").alias("kind"))


def bidirectional(peaks: DataFrame, distance: int = 300) -> DataFrame:
    """Start sites of both strands (chrom, strand, pos, n) as pairs: chrom, start, end, minus, plus, reads.

    A site of the minus strand and one of the plus strand at the same place or downstream, at most `distance` away, are a pair if each is the other's
    nearest. A site is in one pair at most; those without a partner give no row.
    """
    minus = peaks.where("strand = '-'").select("chrom", F.col("pos").alias("start"), (F.col("pos") + distance + 1).alias("end"), F.col("pos").alias("at"), "n")
    plus = peaks.where("strand = '+'").select("chrom", F.col("pos").alias("start"), (F.col("pos") + 1).alias("end"), F.col("pos").alias("at"), "n")
    near = overlap_join(minus, plus).select(F.col("a_chrom").alias("chrom"), F.col("a_at").alias("minus"), F.col("b_at").alias("plus"), (F.col("a_n") + F.col("b_n")).alias("reads"))
    first = near.groupBy("chrom", "minus").agg(F.min("plus").alias("plus"))
    last = near.groupBy("chrom", "plus").agg(F.max("minus").alias("minus"))
    pairs = near.join(first, ["chrom", "minus", "plus"]).join(last, ["chrom", "minus", "plus"])
    return pairs.select("chrom", F.col("minus").alias("start"), (F.col("plus") + 1).alias("end"), "minus", "plus", "reads")
