"""Column functions on alignments and intervals (0-based, half-open)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The bits of an alignment's flag.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE, FIRST, SECOND, SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = (1 << n for n in range(12))
#: Assays whose first mate lies on the strand of the RNA.
FORWARD_STRANDED = ("PROseq", "mNETseq")


def has(flag: Column, bit: int) -> Column:
    return flag.bitwiseAND(F.lit(bit)) != 0


def lacks(flag: Column, bits: int) -> Column:
    """None of several bits, as required or excluded flags add up."""
    return flag.bitwiseAND(F.lit(bits)) == 0


def reference_length(cigar: Column) -> Column:
    """Bases of the reference that a CIGAR string spans (operations M, D, N, = and X)."""
    steps = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n.cast("long"))


def blocks(cigar: Column, start: Column) -> Column:
    """Aligned blocks (start, end) of a CIGAR string: what remains when skipped regions (N) are cut out."""
    steps = F.regexp_extract_all(cigar, F.lit(r"\d+[MDN=X]"), F.lit(0))
    size = lambda s: F.regexp_extract(s, r"\d+", 0).cast("long")
    empty = F.struct(start.cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("done"))

    def step(state: Column, s: Column) -> Column:
        end = state["at"] + size(s)
        one = F.array(F.struct(state["at"].alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(s.endswith("N"), state["done"]).otherwise(F.concat(state["done"], one)).alias("done"))

    return F.aggregate(steps, empty, step, lambda state: state["done"])


def rna_strand(flag: Column) -> Column:
    """The strand of the RNA for a protocol whose second mate (or only read) is read from it."""
    return F.when(has(flag, SECOND) == has(flag, REVERSE), "+").otherwise("-")


def last_base(start: Column, end: Column, strand: Column) -> Column:
    """The one-base interval at a read's first base by strand: its start on plus, its last base on minus."""
    return F.when(strand == "+", F.struct(start.alias("start"), (start + 1).alias("end"))).otherwise(F.struct((end - 1).alias("start"), end.alias("end")))


def end_of_pair(assay: str) -> Column:
    """Of a pair's first mate (start, end, strand, mate_start, mate_end, mate_strand), chrom apart: the one-base interval and strand of
    the 5' end that lies on the RNA's strand, its own for forward-stranded assays, else its mate's."""
    whose = "" if assay in FORWARD_STRANDED else "mate_"
    start, end, strand = (F.col(f"{whose}{c}") for c in ("start", "end", "strand"))
    at = last_base(start, end, strand)
    return F.struct(at["start"].alias("start"), at["end"].alias("end"), strand.alias("strand"))


def is_standard(chrom: Column) -> Column:
    """Numbered contigs, sex chromosomes and the mitochondrion."""
    return chrom.rlike(r"^(chr)?([0-9]+|[XYM]|MT)$")


def group_of(sample: Column) -> Column:
    """The name of a replicate group: what lies before the first underscore."""
    return F.substring_index(sample, "_", 1)


def clip_to(start: Column, end: Column, strand: Column, size: int) -> Column:
    """At most `size` bases at the 5' end."""
    return F.when(strand == "-", F.struct(F.greatest(start, end - size).alias("start"), end.alias("end"))).otherwise(F.struct(start.alias("start"), F.least(end, start + size).alias("end")))
