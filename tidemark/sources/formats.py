"""Readers and writers of interval and sequence formats. Tables hold 0-based, half-open coordinates; readers and writers convert."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import alignment as al

BED = "chrom string, start long, end long, name string, score double, strand string"
GTF = "chrom string, source string, feature string, start long, end long, score string, strand string, frame string, attributes string"
SAM = ["name", "flag", "chrom", "pos", "mapq", "cigar", "mate_chrom", "mate_pos", "tlen", "seq", "qual"]


def read_bed(spark: SparkSession, path: str, columns: int = 3) -> DataFrame:
    """BED3 to BED6; comment, track and browser lines are left out."""
    fields = ", ".join(BED.split(", ")[:columns])
    rows = spark.read.schema(fields).csv(path, sep="\t", comment="#", mode="DROPMALFORMED")
    return rows.where("start IS NOT NULL AND NOT chrom RLIKE '^(track|browser)'")


def read_bedgraph(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("chrom string, start long, end long, depth double").csv(path, sep="\t", comment="#").where("start IS NOT NULL")


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """GTF or GFF3 lines as they are (1-based, closed); gzip is read as it is."""
    return spark.read.schema(GTF).csv(path, sep="\t", comment="#", quote="")


def read_saf(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("gene_id string, chrom string, start long, end long, strand string").csv(path, sep="\t", header=True)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """header, seq: records split at '>' at the start of a line, sequence lines joined."""
    records = spark.read.option("lineSep", "\n>").text(path)
    text = F.regexp_replace("value", "^>", "")
    parts = F.split(text, "\n", 2)
    return records.where(F.trim(text) != "").select(F.trim(parts[0]).alias("header"), F.coalesce(F.regexp_replace(F.get(parts, 1), r"\s", ""), F.lit("")).alias("seq"))


def _fasta_parts(most: int):
    def parts(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pieces of sequences as a split has them: header where one opens in the split, else null; offset since it, or since the split's start."""
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        split, nth, header, done, held, size, out = None, 0, None, 0, [], 0, []

        def give(always: bool = False) -> None:
            nonlocal nth, done, held, size
            if held or always:
                out.append((*split, nth, header, done, "".join(held)))
                nth, done, held, size = nth + 1, done + size, [], 0

        for b in frames:
            for value, file, start in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (file, start) != split:
                    give()
                    split, nth, header, done = (file, start), 0, None, 0
                if value.startswith(">"):
                    give()
                    header, done = value[1:].strip(), 0
                    give(always=True)  # a record without a sequence is one all the same
                    continue
                line = "".join(value.split())
                if line:
                    held.append(line)
                    size += len(line)
                if size >= most:
                    give()
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(list(zip(*out, strict=True)) or [()] * 6, kinds, strict=True)], ["file", "at", "nth", "header", "offset", "seq"])
            out = []
        give()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], ["file", "at", "nth", "header", "offset", "seq"])

    return parts


def read_contigs(spark: SparkSession, path: str, most: int = 1 << 16) -> DataFrame:
    """FASTA split by split: header, start, end, seq, a row for each piece of some `most` letters; every record opens with an empty piece.

    A split does not know what record its first lines belong to. One row a split (its last header, and how many letters follow it)
    goes through windows along each file; what they carry, header and offset, joins back to the pieces that lack it. So a
    chromosome is read by as many tasks as it has splits. gzip files are one split each. Letters before the first header are left out.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    parts = lines.mapInArrow(_fasta_parts(most), "file string, at long, nth long, header string, offset long, seq string")
    letters = F.length("seq")
    opened = F.max_by("nth", F.when(F.col("header").isNotNull(), F.col("nth")))
    splits = parts.groupBy("file", "at").agg(F.max_by("header", F.when(F.col("header").isNotNull(), F.col("nth"))).alias("last"), opened.alias("opened"), F.max(F.struct("nth", (F.col("offset") + letters).alias("tail"))).alias("x"))
    along = W.partitionBy("file").orderBy("at").rowsBetween(W.unboundedPreceding, -1)  # a row for each split
    splits = splits.select("file", "at", "last", "opened", F.coalesce(F.sum("x.tail").over(along), F.lit(0)).alias("before"))
    here = F.when(F.col("last").isNotNull(), F.struct("last", "before", "at", "opened"))
    splits = splits.withColumn("from", F.last(here, ignorenulls=True).over(along)).select("file", "at", F.col("from.last").alias("carried"), (F.col("before") - F.col("from.before")).alias("shift"))
    both = parts.join(splits, ["file", "at"]).withColumn("own", F.col("header").isNotNull())
    start = F.col("offset") + F.when(F.col("own"), 0).otherwise(F.col("shift"))
    rows = both.select(F.coalesce("header", "carried").alias("header"), start.alias("start"), (start + letters).alias("end"), "seq").where("header IS NOT NULL")
    return rows.where("seq <> '' OR start = 0")


def contig_lengths(contigs: DataFrame) -> DataFrame:
    """Of read_contigs: chrom (the header up to its first blank), length."""
    return contigs.groupBy(F.regexp_extract("header", r"^(\S*)", 1).alias("chrom")).agg(F.max("end").alias("length"))


def contig_gc(contigs: DataFrame) -> DataFrame:
    """Of read_contigs: header, bases, gc (their share of G and C; null without a base)."""
    upper = F.upper("seq")
    of = lambda c: F.length("seq") - F.length(F.translate(upper, c, ""))
    by = contigs.groupBy("header").agg(F.sum(F.length("seq")).alias("bases"), F.sum(of("GC")).alias("n"))
    return by.select("header", "bases", F.when(F.col("bases") > 0, F.round(F.col("n") / F.col("bases"), 6)).alias("gc"))


def _fastq_pieces(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records out of text cut where a line starts with '@'. A quality line that does so too is a piece of its own; where a split's end
    parts it from its record, the two leave as rows with a place: `opens` for what lacks a quality, `closes` for a quality."""
    held, split = None, None
    for b in frames:
        out = []
        for value, file, start in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (file, start) != split:
                if held:
                    out.append((held[0], held[1], None, *split, "opens"))
                held, split, first = None, (file, start), start == 0
                if first:
                    value = value.removeprefix("@")
            lines = [x.removesuffix("\r") for x in value.split("\n")]
            while len(lines) > 4 and not lines[-1]:
                lines.pop()
            if len(lines) <= 2 and not any(lines[1:]):  # a quality without its '@', perhaps the file's last line
                quality = "@" + lines[0]
                out.append((held[0], held[1], quality, None, None, None) if held else (None, None, quality, *split, "closes"))
                held = None
            elif held is None and len(lines) == 3 and lines[2].startswith("+"):
                held = lines
            elif held is None and len(lines) == 4 and lines[2].startswith("+"):
                out.append((lines[0], lines[1], lines[3], None, None, None))
            else:
                raise ValueError(f"no record of four lines in {file}: {value[:80]!r}")
        columns = list(zip(*out, strict=True)) or [()] * 6
        kinds = [pa.string()] * 4 + [pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], ["name", "seq", "qual", "file", "at", "part"])
    if held:
        yield pa.RecordBatch.from_pylist([{"name": held[0], "seq": held[1], "file": split[0], "at": split[1], "part": "opens"}], schema=pa.schema([(n, t) for n, t in zip(["name", "seq", "qual", "file", "at", "part"], [pa.string()] * 4 + [pa.int64(), pa.string()], strict=True)]))


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """name (up to the first blank), seq, qual of four-line records; a quality line may start with '@'.

    Files are read split by split. Records parted by a split's end, at most one a split, are put together in a second pass over
    files that are not gzip. Lines that form no record, or a sequence and a quality of two lengths, are an error.
    """

    def pieces(which: str) -> DataFrame:
        text = spark.read.option("lineSep", "\n@").text(path).where(which)
        return text.select("value", "_metadata.file_path", "_metadata.file_block_start").mapInArrow(_fastq_pieces, "name string, seq string, qual string, file string, at long, part string")

    whole, plain = pieces("_metadata.file_name LIKE '%.gz'"), pieces("NOT _metadata.file_name LIKE '%.gz'")
    nth = F.row_number().over(W.partitionBy("file", "part").orderBy("at"))  # a row for each split at most
    parted = plain.where("part IS NOT NULL").withColumn("nth", nth)  # the same files and so the same splits in both passes
    opens, closes = parted.where("part = 'opens'"), parted.where("part = 'closes'").select("file", "nth", "qual")
    both = opens.drop("qual").join(closes, ["file", "nth"], "full")
    rows = whole.unionByName(plain.where("part IS NULL")).unionByName(both.select("name", "seq", "qual", "file", "at", "part"))
    broken = F.raise_error(F.concat(F.lit("a record lacks lines or letters: "), F.coalesce("name", "qual", F.lit(""))))
    checked = F.when(F.length("seq") == F.length("qual"), F.col("qual")).otherwise(broken)
    return rows.select(F.regexp_extract("name", r"^\s*(\S*)", 1).alias("name"), "seq", checked.alias("qual"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text as intervals; optional fields as a map; a mate's contig given as '=' is the read's own."""
    fields = F.split("value", "\t")
    rows = spark.read.text(path).where("NOT value RLIKE '^@[A-Z][A-Z]\t'").select(*[fields[i].alias(c) for i, c in enumerate(SAM)], F.slice(fields, F.lit(12), F.greatest(F.size(fields) - 11, F.lit(0))).alias("extra"))
    start = F.col("pos").cast("long") - 1
    tags = F.map_from_entries(F.transform("extra", lambda x: F.struct(F.substring_index(x, ":", 1), F.regexp_replace(x, "^[^:]*:[^:]*:", ""))))
    flag = F.col("flag").cast("int")
    return rows.select("name", flag.alias("flag"), F.nullif("chrom", F.lit("*")).alias("chrom"), start.alias("start"), (start + al.reference_length(F.col("cigar"))).alias("end"), F.when(al.has(flag, al.REVERSE), "-").otherwise("+").alias("strand"), F.col("mapq").cast("int").alias("mapq"), "cigar", F.when(F.col("mate_chrom") == "=", F.nullif("chrom", F.lit("*"))).otherwise(F.nullif("mate_chrom", F.lit("*"))).alias("mate_chrom"), (F.col("mate_pos").cast("long") - 1).alias("mate_start"), F.col("tlen").cast("int").alias("tlen"), "seq", "qual", tags.alias("tags"))


def read_samplesheet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("sample string, fastq_1 string, fastq_2 string").csv(path, header=True)


def read_tuning(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("LtProbB int, UTS int, merged int, dissociated int, total int, errorRate double, txSize int").csv(path, header=True)


def write_bed(table: DataFrame, path: str) -> None:
    """Sorted, without a header, a column after the other."""
    table.sort("chrom", "start").write.csv(path, sep="\t", header=False)


def write_bedgraph(depth: DataFrame, path: str) -> None:
    write_bed(depth.select("chrom", "start", "end", "depth"), path)


def write_by_key(table: DataFrame, key: str, path: str, header: bool = True) -> None:
    """One folder per key: rows of a key gathered, with a header each."""
    table.write.partitionBy(key).csv(path, header=header)


def write_tags(reads: DataFrame, path: str, size: int = 1 << 20) -> None:
    """Alignments by contig and bins of `size` bases, sorted by start within: path/tags, and path/bins, one row a bin: how many reads begin in it, and
    how far they reach. Rows of a null contig or start are left out."""
    rows = reads.where("chrom IS NOT NULL AND start IS NOT NULL").withColumn("bin", F.floor(F.col("start") / size))
    rows.repartition("chrom", "bin").sortWithinPartitions("chrom", "bin", "start").write.partitionBy("chrom", "bin").parquet(f"{path}/tags")
    spark = reads.sparkSession
    spark.read.parquet(f"{path}/tags").groupBy("chrom", "bin").agg(F.min("start").alias("first"), F.max("end").alias("reach"), F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/bins")


def read_region(spark: SparkSession, path: str, chrom: str, start: int, end: int) -> DataFrame:
    """What write_tags wrote and overlaps a region. Only files of bins are opened that hold a read that could: those that begin before its end
    and reach beyond its start."""
    bins = spark.read.schema("chrom string, bin long, first long, reach long, n long").parquet(f"{path}/bins").where((F.col("chrom") == chrom) & (F.col("first") < end) & (F.col("reach") > start))
    wanted = [r.bin for r in bins.select("bin").collect()]  # bins of the region
    rows = spark.read.parquet(f"{path}/tags").where((F.col("chrom") == chrom) & F.col("bin").isin(wanted))
    return rows.where((F.col("start") < end) & (F.col("end") > start)).drop("bin")
