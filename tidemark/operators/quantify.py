"""Reads counted by feature, with ambiguity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import alignment as al

from .intervals import merge_intervals, overlap_join
from .samples import mix


def assign(reads: DataFrame, features: DataFrame, strandedness: int = 0, least_mapq: int = 0, both_ends: bool = False, chimeric: bool = True) -> DataFrame:
    """id, sample, gene, status of every read; ids may be null or repeat.

    features: gene, chrom, start, end, strand; several rows of a gene count as one. strandedness: 0 any strand, 1 that of the gene,
    2 the other. Reads over several genes are Unassigned_Ambiguity, over none Unassigned_NoFeatures; unmapped, secondary, low
    quality reads and, with both_ends, those whose mate is unmapped are not compared, nor without `chimeric` those whose mate lies on
    another contig (mate_chrom).
    """
    f = F.col("flag")
    early = F.when(al.has(f, al.UNMAPPED), "Unassigned_Unmapped").when(F.col("mapq") < least_mapq, "Unassigned_MappingQuality")
    early = early.when(al.has(f, al.SECONDARY), "Unassigned_Secondary")
    if both_ends:
        early = early.when(al.has(f, al.PAIRED) & al.has(f, al.MATE_UNMAPPED), "Unassigned_Singleton")
    if not chimeric:
        early = early.when(al.has(f, al.PAIRED) & al.lacks(f, al.MATE_UNMAPPED) & (F.col("mate_chrom") != F.col("chrom")), "Unassigned_Chimera")
    side = F.translate("strand", "+-", "-+") if strandedness == 2 else F.col("strand")
    rows = reads.select("id", "sample", "chrom", "start", "end", side.alias("strand"), early.alias("early"))
    keys = ("chrom", "strand") if strandedness else ("chrom",)
    place = [*keys, "start", "end"]
    # Reads at one place fare alike: each place is looked up once, however deep it is, and reads need no id.
    places = rows.where("early IS NULL").select(*place).distinct()
    hits = overlap_join(places, features.select("gene", *keys, "start", "end"), keys)
    hits = hits.groupBy(*[F.col(f"a_{c}").alias(c) for c in place]).agg(F.min("b_gene").alias("low"), F.max("b_gene").alias("high"))
    out = rows.join(hits, place, "left")
    status = F.coalesce("early", F.when(F.col("low").isNull(), "Unassigned_NoFeatures").when(F.col("low") != F.col("high"), "Unassigned_Ambiguity").otherwise("Assigned"))
    return out.select("id", "sample", F.when(status == "Assigned", F.col("low")).alias("gene"), status.alias("status"))


def assign_each(reads: DataFrame, annotations: dict[str, DataFrame], **options) -> DataFrame:
    """assign for every pair of a replicate group and an annotation: annotation, group, id, sample, gene (as text), status."""
    parts = []
    for name, features in annotations.items():  # a few tables of features
        of = assign(reads, features, **options).withColumn("gene", F.col("gene").cast("string"))
        parts.append(of.select(F.lit(name).alias("annotation"), al.group_of(F.col("sample")).alias("group"), "id", "sample", "gene", "status"))
    return mix(*parts)


def lengths(features: DataFrame) -> DataFrame:
    """gene, length: bases of the union of a gene's features."""
    merged = merge_intervals(features, ("gene", "chrom"))
    return merged.groupBy("gene").agg(F.sum(F.col("end") - F.col("start")).alias("length"))


def counts(assigned: DataFrame, features: DataFrame, samples: DataFrame) -> DataFrame:
    """gene, length, sample, n for every gene and sample, 0 included."""
    n = assigned.where("status = 'Assigned'").groupBy("gene", "sample").agg(F.count(F.lit(1)).alias("n"))
    every = lengths(features).crossJoin(samples.select("sample").distinct())  # a sample sheet
    return every.join(n, ["gene", "sample"], "left").select("gene", "length", "sample", F.coalesce("n", F.lit(0)).alias("n"))


def summary(assigned: DataFrame) -> DataFrame:
    """sample, status, n."""
    return assigned.groupBy("sample", "status").agg(F.count(F.lit(1)).alias("n"))
