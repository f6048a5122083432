"""Annotation tables: exons to transcripts, names, sequences, attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.sources.shared import kept

from .intervals import STRETCH


def gtf_to_bed12(gtf: DataFrame) -> DataFrame:
    """Transcripts with their exons as blocks: chrom, start, end, name, score, strand, thick_start, thick_end, rgb, block_count, block_sizes, block_starts.

    gtf: line_no, chrom, feature, start, end (1-based, closed), strand, transcript_id. Contig and strand are those of the first exon
    line. A start and stop codon bound the thick part; of several, the last line counts. Transcripts without an exon give no row.
    """
    exon = F.col("feature").isin("exon", "miRNA")
    codon = lambda name, place: F.max_by(place, F.when(F.col("feature") == name, F.col("line_no")))
    rows = gtf.where(F.col("transcript_id").isNotNull() & F.col("chrom").isNotNull() & (exon | F.col("feature").isin("start_codon", "stop_codon")))
    by = rows.groupBy("transcript_id").agg(
        F.min_by("chrom", F.when(exon, F.col("line_no"))).alias("chrom"),
        F.min_by("strand", F.when(exon, F.col("line_no"))).alias("strand"),
        F.sort_array(F.collect_list(F.when(exon, F.struct("start", "line_no", "end")))).alias("exons"),
        codon("start_codon", F.col("start")).alias("first"),
        codon("stop_codon", F.col("end")).alias("last"),
    )
    by = by.where(F.size("exons") > 0).withColumn("beg", F.element_at("exons", 1)["start"]).withColumn("stop", F.element_at("exons", -1)["end"])
    minus = F.col("strand") == "-"
    thick_start = F.coalesce(F.when(minus, F.col("last") - 2).otherwise(F.col("first")), "beg") - 1
    thick_end = F.coalesce(F.when(minus, F.col("first") + 2).otherwise(F.col("last")), "stop")
    text = lambda value: F.concat(F.array_join(F.transform("exons", lambda e: value(e).cast("string")), ","), F.lit(","))
    return by.select(
        "chrom",
        (F.col("beg") - 1).alias("start"),
        F.col("stop").alias("end"),
        F.col("transcript_id").alias("name"),
        F.lit(0).alias("score"),
        "strand",
        thick_start.alias("thick_start"),
        thick_end.alias("thick_end"),
        F.lit(0).alias("rgb"),
        F.size("exons").cast("long").alias("block_count"),
        text(lambda e: e["end"] - e["start"] + 1).alias("block_sizes"),
        text(lambda e: e["start"] - F.col("beg")).alias("block_starts"),
    )


def keep_known(gtf: DataFrame, sequences: DataFrame) -> DataFrame:
    """Rows whose contig is among the sequences (seqname)."""
    return gtf.join(sequences.select(F.col("seqname").alias("chrom")), "chrom", "left_semi").select(*gtf.columns)


#: Contigs left out of the start-site caller by default.
SKIPPED = ("chrY", "_random", "chrUn_", "chrEBV", "chrM")


def drop_contigs(names: DataFrame, skip: tuple[str, ...] = SKIPPED) -> DataFrame:
    """Contigs whose whole name is not in the list."""
    return names.where(~F.col("chrom").isin(*skip))


#: The source and the keys of the attributes of sequences turned into annotation.
TRANSGENE, TRANSGENE_KEYS = "transgene", ("gene_id", "gene_name", "transcript_id", "gene_biotype", "gene_type")


def fasta_to_gtf(sequences: DataFrame, source: str = TRANSGENE) -> DataFrame:
    """One exon per sequence, from 1 to its length on plus; the first word of the header is the value of every attribute."""
    name = F.split(F.ltrim("header"), r"\s+")[0]
    attributes = F.concat_ws("; ", *[F.concat(F.lit(f'{k} "'), name, F.lit('"')) for k in TRANSGENE_KEYS])
    return sequences.select(name.alias("chrom"), F.lit(source).alias("source"), F.lit("exon").alias("feature"), F.lit(1).cast("long").alias("start"), F.length("seq").cast("long").alias("end"), F.lit(".").alias("score"), F.lit("+").alias("strand"), F.lit(".").alias("frame"), attributes.alias("attributes"))


def positions_to_bed(positions: DataFrame) -> DataFrame:
    """Peak positions (name, chrom, start and end counted from 1, strand, score) as BED6 rows."""
    return positions.select("chrom", (F.col("start") - 1).alias("start"), "end", "name", "score", "strand")


def chrom_sizes(sequences: DataFrame) -> DataFrame:
    """chrom, length: of sequences in one or several lines each."""
    return sequences.groupBy(F.split("header", r"\s+")[0].alias("chrom")).agg(F.sum(F.length("seq")).alias("length"))


def attribute(attributes: Column, key: str) -> Column:
    """A value of a GTF attribute string (key "value";) or a GFF3 one (key=value;)."""
    return F.nullif(F.coalesce(F.nullif(F.regexp_extract(attributes, rf'(?:^|;)\s*{key} "([^"]*)"', 1), F.lit("")), F.regexp_extract(attributes, rf"(?:^|;)\s*{key}=([^;]*)", 1)), F.lit(""))


def ancestors(links: DataFrame, most: int = 40) -> DataFrame:
    """id, root: of links (id, parent), the topmost ancestor of every id that has a parent, over any number of levels.

    Each round every id takes over its ancestor's ancestor, so n levels take log2(n) rounds; only whether one changed reaches the
    driver. An id with several parents keeps the one of the smallest name at each step; a cycle is an error.
    """
    up = links.where("id IS NOT NULL AND parent IS NOT NULL").groupBy("id").agg(F.min("parent").alias("root"))
    for _ in range(most):
        up = kept(up.join(up.select(F.col("id").alias("root"), F.col("root").alias("above")), "root", "left").select("id", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "ancestors")
        if up.where("moved").isEmpty():
            return up.drop("moved")
        up = up.drop("moved")
    raise ValueError("parents form a cycle")


def gff_to_gtf(gff: DataFrame) -> DataFrame:
    """Exons and coding parts of a GFF3 table with transcript names from their parents and gene names from the topmost ancestor: attributes in GTF form."""
    rows = gff.withColumn("id", attribute(F.col("attributes"), "ID")).withColumn("parent", attribute(F.col("attributes"), "Parent"))
    genes = ancestors(rows.select("id", F.explode(F.split("parent", ",")).alias("parent"))).select(F.col("id").alias("transcript_id"), F.col("root").alias("gene_id"))
    parts = rows.where(F.col("feature").isin("exon", "CDS")).withColumn("transcript_id", F.explode(F.split("parent", ",")))
    named = parts.join(genes, "transcript_id", "left").withColumn("gene_id", F.coalesce("gene_id", "transcript_id"))
    return named.withColumn("attributes", F.format_string('transcript_id "%s"; gene_id "%s";', "transcript_id", "gene_id")).select(*gff.columns)


def transcript_table(gtf: DataFrame) -> DataFrame:
    """gene_id, tx_name, chrom, strand, start, end (0-based, half-open), exons of every transcript of a GTF table, from its exon lines.

    Transcripts of one name on several contigs or strands stay apart; lines without a transcript_id go; a missing gene_id is null.
    """
    rows = gtf.where("feature = 'exon'").select(attribute(F.col("attributes"), "gene_id").alias("gene_id"), attribute(F.col("attributes"), "transcript_id").alias("tx_name"), "chrom", "strand", "start", "end")
    by = rows.where("tx_name IS NOT NULL").groupBy("tx_name", "chrom", "strand")
    out = by.agg(F.min("gene_id").alias("gene_id"), (F.min("start") - 1).cast("long").alias("start"), F.max("end").cast("long").alias("end"), F.count(F.lit(1)).alias("exons"))
    return out.select("gene_id", "tx_name", "chrom", "strand", "start", "end", "exons")


def gc_content(sequences: DataFrame) -> DataFrame:
    """chrom, bases, gc: the share of G and C among A, C, G and T; null without any of them. Sequences may come in several lines each."""
    seq = F.upper("seq")
    count = lambda letters: F.sum(F.length(F.regexp_replace(seq, f"[^{letters}]", "")))
    by = sequences.groupBy(F.split("header", r"\s+")[0].alias("chrom")).agg(count("ACGT").alias("bases"), count("GC").alias("gc"))
    return by.select("chrom", "bases", F.when(F.col("bases") > 0, F.round(F.col("gc") / F.col("bases"), 6)).alias("gc"))


def consensus(transcripts: DataFrame) -> DataFrame:
    """One interval per gene from its isoforms: the part common to all, or their union where they have none. gene, chrom, strand, start, end."""
    by = transcripts.groupBy("gene", "chrom", "strand").agg(F.max("start").alias("inner_start"), F.min("end").alias("inner_end"), F.min("start").alias("start"), F.max("end").alias("end"))
    common = F.col("inner_start") < F.col("inner_end")
    return by.select("gene", "chrom", "strand", F.when(common, F.col("inner_start")).otherwise(F.col("start")).alias("start"), F.when(common, F.col("inner_end")).otherwise(F.col("end")).alias("end"))


def first_wins(table: DataFrame, value: str, order: str) -> DataFrame:
    """The row with the smallest value; of equal ones the first in order."""
    return table.orderBy(value, order).limit(1)


def number(rows: DataFrame, prefix: str = "TX") -> DataFrame:
    """rows with names where they have none: the prefix and their place by contig and start, counted per contig.

    Places are counted within stretches of a contig, and stretches by their sizes. A row without a start comes first.
    """
    rows = rows.withColumn("_stretch", F.coalesce(F.floor(F.col("start") / STRETCH), F.lit(-1)))
    along = W.partitionBy("_c").orderBy("_s").rowsBetween(W.unboundedPreceding, -1)
    sizes = rows.groupBy(F.col("chrom").alias("_c"), F.col("_stretch").alias("_s")).agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select("_c", "_s", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_base"))
    placed = rows.join(sizes, F.col("chrom").eqNullSafe(F.col("_c")) & (F.col("_stretch") == F.col("_s")))
    w = W.partitionBy("chrom", "_stretch").orderBy("start", "end", "strand")
    nth = F.col("_base") + F.row_number().over(w)
    return placed.withColumn("name", F.coalesce("name", F.concat(F.lit(prefix), F.col("chrom"), F.lit("."), nth))).drop("_stretch", "_c", "_s", "_base")
