"""Interval operators against brute force, formats by round trip, queries against their SQL."""

import gzip
import math
import os

import duckdb
import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__
from tidemark.functions import alignment as al
from tidemark.operators import annotation, coverage, dedup, intervals, qc, quantify, samples, transcripts
from tidemark.plans import catalogue
from tidemark.sources import formats
from tidemark.streaming import sessions

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def bed(spark, rows):
    return spark.createDataFrame(rows, "chrom string, start long, end long")


def tuples(df):
    return sorted(map(tuple, df.collect()))


SPANS = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60), st.integers(0, 20)).map(lambda x: (x[0], x[1], x[1] + x[2])), max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(SPANS, SPANS)
def test_against_brute_force(spark, a, b):
    got = {}
    for c, s, e, d in tuples(coverage.coverage(bed(spark, a), stretch=7)):
        got |= {(c, p): d for p in range(s, e)}
    want = {}
    for c, s, e in a:
        for p in range(s, e):
            want[c, p] = want.get((c, p), 0) + 1
    assert got == want
    merged = {(c, p) for c, s, e, _ in tuples(intervals.merge_intervals(bed(spark, a), stretch=7)) for p in range(s, e)}
    assert merged == set(want)
    full = [x for x in a if x[1] < x[2]]
    hits = lambda x: [y for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2] and y[1] < y[2]]
    assert tuples(intervals.intersect(bed(spark, a), bed(spark, b), bin_size=8)) == sorted(x for x in full for _ in hits(x))
    assert tuples(intervals.intersect(bed(spark, full), bed(spark, b), "any", bin_size=8)) == sorted(x for x in full if hits(x))
    assert tuples(intervals.intersect(bed(spark, full), bed(spark, b), "none", bin_size=8)) == sorted(x for x in full if not hits(x))


def test_book_ends_and_depth(spark):
    assert tuples(intervals.merge_intervals(bed(spark, [("a", 0, 5), ("a", 5, 9), ("a", 10, 11)]))) == [("a", 0, 9, 2), ("a", 10, 11, 1)]
    assert tuples(coverage.coverage(bed(spark, [("a", 0, 5), ("a", 0, 5), ("a", 5, 9)]))) == [("a", 0, 5, 2), ("a", 5, 9, 1)]
    assert tuples(coverage.mean_depth(bed(spark, [("a", 0, 75)]), 50)) == [("a", 0, 1.0), ("a", 1, 0.5)]


def test_alignment_functions(spark):
    row = spark.createDataFrame([("5M2D3M10N4M2S", 100, 16 | 128)], "cigar string, start long, flag int")
    got = row.select(al.reference_length(F.col("cigar")).alias("n"), al.blocks(F.col("cigar"), F.col("start")).alias("b"), al.rna_strand(F.col("flag")).alias("s")).first()
    assert got.n == 24 and [tuple(b) for b in got.b] == [(100, 105), (105, 107), (107, 110), (120, 124)] and got.s == "+"


def test_counting(spark):
    genes = spark.createDataFrame([("g1", "a", 0, 10, "+"), ("g1", "a", 5, 20, "+"), ("g2", "a", 18, 30, "-")], "gene string, chrom string, start long, end long, strand string")
    reads = spark.createDataFrame([("r1", "s", "a", 2, 4, "+", 0, 60), ("r2", "s", "a", 19, 22, "+", 0, 60), ("r3", "s", "a", 40, 42, "+", 0, 60), ("r4", "s", "a", 25, 28, "+", 4, 60)], "id string, sample string, chrom string, start long, end long, strand string, flag int, mapq int")
    status = {r.id: (r.gene, r.status) for r in quantify.assign(reads, genes).collect()}
    assert status == {"r1": ("g1", "Assigned"), "r2": (None, "Unassigned_Ambiguity"), "r3": (None, "Unassigned_NoFeatures"), "r4": (None, "Unassigned_Unmapped")}
    assert {r.id: r.gene for r in quantify.assign(reads, genes, strandedness=1).collect()}["r2"] == "g1"
    assert tuples(quantify.lengths(genes)) == [("g1", 20), ("g2", 12)]


def test_transcripts_to_bed12(spark):
    lines = [(1, "c", "exon", 101, 110, "-", "t"), (2, "c", "exon", 201, 220, "-", "t"), (3, "c", "start_codon", 205, 207, "-", "t"), (4, "c", "stop_codon", 103, 105, "-", "t"), (5, "c", "start_codon", 1, 3, "+", "none")]
    row = annotation.gtf_to_bed12(spark.createDataFrame(lines, "line_no long, chrom string, feature string, start long, end long, strand string, transcript_id string")).collect()
    assert [tuple(r) for r in row] == [("c", 100, 220, "t", 0, "-", 102, 207, 0, 2, "10,20,", "0,100,")]


def test_sample_sheets(spark):
    sheet = spark.createDataFrame([("a", "1.fq.gz", None), ("a", "2.fq.gz", "2b.fq.gz"), ("b c", "x.txt", None)], "sample string, fastq_1 string, fastq_2 string")
    assert samples.invalid_rows(sheet).count() == 2
    with pytest.raises(Exception, match="single-end or all paired"):
        samples.check_groups(samples.group_samples(sheet)).collect()
    empty = spark.createDataFrame([], "x int")
    assert tuples(samples.default_row(empty, {"x": 3})) == [(3,)] and tuples(samples.default_row(spark.createDataFrame([(1,)], "x int"), {"x": 3})) == [(1,)]


def test_molecules(spark):
    rows = [("s", "c", 1, "+", u, 50, f"{u}{i}") for u, n in (("AAAA", 10), ("AAAT", 3), ("AATT", 1), ("GGGG", 2)) for i in range(n)]
    reads = spark.createDataFrame(rows, "sample string, chrom string, pos long, strand string, umi string, mapq long, id string")
    assert dedup.exact_umis(reads, "id").count() == 4
    assert sorted((r.umi, r.reads, r.umis) for r in dedup.directional_umis(reads).collect()) == [("AAAA", 14, 3), ("GGGG", 2, 1)]
    odd = spark.createDataFrame([("s", None, 1, "+", u, 50, "") for u in ("AA", "AT", None, "AA", "AA")] + [("s", "d", p, "+", "CC", 50, "") for p in range(9)], reads.schema)
    assert sorted((str(r.chrom), r.umi, r.reads, r.umis) for r in dedup.directional_umis(odd).collect()) == [("None", "AA", 4, 2)] + [("d", "CC", 1, 1)] * 9
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # places go over the ends of batches
    try:
        wide = spark.createDataFrame([("s", "c", p, "+", u, 50, "") for p in range(6) for u in ("AAAA", "AAAA", "AAAT", "GGGG", "CCCC", "TTTT")], reads.schema)
        assert sorted((r.pos, r.umi, r.reads) for r in dedup.directional_umis(wide).collect()) == [(p, u, n) for p in range(6) for u, n in (("AAAA", 3), ("CCCC", 1), ("GGGG", 1), ("TTTT", 1))]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    histogram = dedup.complexity_histogram(reads, "umi")
    curve = [r.distinct for r in dedup.c_curve(histogram).orderBy("step").collect()]
    assert curve == sorted(curve) and curve[-1] == 4.0
    yields = [r.expected_distinct for r in dedup.lc_extrap(histogram).orderBy("total_reads").collect()]
    assert yields[0] == 4 and yields == sorted(yields)


def test_calls(spark):
    rng = np.random.default_rng(1)
    counts = [("c", "+", i, int(rng.poisson(20)) + 1) for i in range(100, 180)] + [("c", "+", i, 1) for i in range(0, 60, 7)]
    table = spark.createDataFrame(counts, "chrom string, strand string, bin long, n long")
    hmm = transcripts.hmm_transcripts(table, 50, log_leave=-10.0).collect()
    assert any(abs(r.start - 5000) <= 100 and abs(r.end - 9000) <= 100 for r in hmm)
    assert any(r.start <= 5200 and r.end >= 8800 for r in transcripts.dense_transcripts(table).collect())
    ends = [("c", "+", p, 1) for p in range(0, 2000, 10)] + [("c", "+", 1005, 60), ("c", "-", 900, 50)] + [("c", "-", p, 1) for p in range(3, 2000, 10)]
    peaks = transcripts.tss_peaks(spark.createDataFrame(ends, "chrom string, strand string, pos long, n long")).collect()
    assert sorted((r.pos, r.kind) for r in peaks) == [(900, "divergent"), (1005, "divergent")]


def test_tuning(spark):
    """Each pair of the grid calls what the single caller does; errors follow from the calls; the error rate of the bundled example."""
    rng = np.random.default_rng(4)
    counts = [("c", s, i, int(rng.poisson(12)) + 1) for s in "+-" for a in (10, 70, 150) for i in range(a, a + 40)]
    table = spark.createDataFrame(counts, "chrom string, strand string, bin long, n long")
    genes = spark.createDataFrame([(i, "c", "+", 500 + 3500 * i, 1500 + 3500 * i) for i in range(3)], "gene long, chrom string, strand string, start long, end long")
    params = transcripts.grid(spark, uts=(5, 45, 20), ltprobb=(-10, -40, -30))
    calls, errors = transcripts.hmm_grid(table, params), {r.row_no: r for r in transcripts.tune(table, genes, params).collect()}
    assert len(errors) == 6
    for p in params.collect():
        own = calls.where(F.col("row_no") == p.row_no).drop("row_no")
        assert tuples(own) == tuples(transcripts.hmm_transcripts(table, 50, float(p.LtProbB), float(p.UTS)))
        want = transcripts.evaluate(own.withColumn("id", F.concat_ws(":", "strand", "start")), genes).first()
        assert all(errors[p.row_no][c] == want[c] for c in want.asDict())
    assert spark.range(1).select(transcripts.error_rate(F.lit(10), F.lit(921), F.lit(698))).first()[0] == 0.006177


def test_pairs(spark):
    rows = [(1 | 2 | 64, "c", 10, 20, "+", "c", 40, 50, "-"), (1 | 8 | 64, "c", 10, 20, "+", None, None, None, None), (1 | 64, "c", 10, 20, "+", "d", 40, 50, "-"), (0, "c", 1, 2, "+", None, None, None, None)]
    reads = spark.createDataFrame(rows, "flag int, chrom string, start long, end long, strand string, mate_chrom string, mate_start long, mate_end long, mate_strand string")
    assert [dedup.whole_pairs(reads, u, c).count() for u, c in ((False, False), (False, True), (True, False), (True, True))] == [1, 2, 3, 4]
    first = reads.limit(1)
    assert [tuple(first.select(al.end_of_pair(a)).first()[0]) for a in ("PROseq", "GROseq")] == [(10, 11, "+"), (49, 50, "-")]
    genes = spark.createDataFrame([("g", "c", 0, 30, "+")], "gene string, chrom string, start long, end long, strand string")
    status = quantify.assign(reads.selectExpr("string(flag) AS id", "'s' AS sample", "60 AS mapq", "*"), genes, chimeric=False)
    assert sorted((r.id, r.status) for r in status.collect()) == [("0", "Assigned"), ("65", "Unassigned_Chimera"), ("67", "Assigned"), ("73", "Assigned")]


def test_stretches_across_blocks(spark):
    """Gaps and stretches are the same however bins are dealt into blocks."""
    rng = np.random.default_rng(7)
    bins = sorted({(c, int(b)) for c in "ab" for b in rng.integers(0, 400, 60)})
    table = spark.createDataFrame([(c, b, 1) for c, b in bins], "chrom string, bin long, n long")
    want, open_ = {}, {}
    for c, b in bins:
        last = max((x for y, x in bins if y == c and x < b), default=None)
        open_[c] = b if last is None or b - last > 9 else open_[c]
        want[c, b] = open_[c]
    for block in (3, 64, 1000):
        got = {(r.chrom, r.bin): r.stretch for r in transcripts.active_stretches(table, ("chrom",), 9, block).collect()}
        assert got == want


def test_start_sites_at_block_edges(spark):
    """A peak's surroundings are whole where a block of positions ends; the cut is that of one sorted list of p-values."""
    edge, rng = 1 << 16, np.random.default_rng(2)
    ends = {int(p): int(n) for p, n in zip(rng.integers(edge - 600, edge + 600, 300), rng.integers(1, 4, 300), strict=True)} | {edge - 2: 40, edge + 1: 30}
    rows = [("c", "+", p, n) for p, n in ends.items()]
    got = {r.pos: r.p for r in transcripts.tss_peaks(spark.createDataFrame(rows, "chrom string, strand string, pos long, n long")).collect()}
    p = {}
    for pos, n in ends.items():
        rate = max(sum(m for q, m in ends.items() if abs(q - pos) <= 100 and q != pos) / 200, 0.01)
        p[pos] = 1 - sum(math.exp(k * math.log(rate) - rate - math.lgamma(k + 1)) for k in range(n))
    ranked = sorted(p.values())
    limit = max((v for i, v in enumerate(ranked) if v <= 0.1 * (i + 1) / len(ranked)), default=-1)
    assert set(got) == {pos for pos, v in p.items() if v <= limit} and {edge - 2, edge + 1} <= set(got)
    assert all(abs(got[pos] - p[pos]) < 1e-9 for pos in got)


def test_gather(spark):
    sites = spark.createDataFrame([("chr1", 5), ("chr1", 7), ("chr1", 20), ("x1", 3)], "chrom string, pos long")
    assert tuples(transcripts.gather_peaks(transcripts.on_contigs(sites, ("chr", "y")), 1)) == [("chr1", 5, 8, 2), ("chr1", 20, 21, 1)]
    assert transcripts.on_contigs(sites, ()).count() == 0


def test_junction_saturation(spark):
    rows = [("c", 1, 9, d) for d in (0, 4, 30)] + [("c", 2, 9, 97)] + [("d", 1, 9, 50)]
    introns, known = spark.createDataFrame(rows, "chrom string, start long, end long, deal long"), bed(spark, [("c", 1, 9), ("c", 1, 9)])
    once, twice = ({r.percent: (r.known, r.novel) for r in qc.junction_saturation(introns, known, F.col("deal"), 5, n).collect()} for n in (1, 3))
    assert (once[5], once[55], once[100], len(once)) == ((1, 0), (1, 1), (1, 2), 20) and (twice[30], twice[35], twice[100]) == ((0, 0), (1, 0), (1, 0))


def test_transcript_integrity(spark):
    """Even depth gives 100; depth on a quarter of a transcript 25; none 0; overlapping exons count once."""
    exons = spark.createDataFrame([("t", "c", 0, 60), ("t", "c", 40, 100), ("u", "c", 200, 300), ("v", "d", 0, 9)], "transcript string, chrom string, start long, end long")
    depth = spark.createDataFrame([("c", 0, 150, 3), ("c", 225, 250, 7)], "chrom string, start long, end long, depth long")
    assert tuples(qc.transcript_integrity(depth, exons)) == [("t", 100, 300, 100.0), ("u", 100, 175, 25.0), ("v", 9, 0, 0.0)]


def test_contigs(spark):
    sizes = spark.createDataFrame([("c", 10), ("d", 10)], "chrom string, length long")
    depth = spark.createDataFrame([("c", 0, 4, 2), ("c", 4, 7, 5)], "chrom string, start long, end long, depth long")
    assert tuples(coverage.median_depth(depth, sizes)) == [("c", 2), ("d", 0)]
    reads = spark.createDataFrame([("c", "+"), ("c", "-"), ("c", "+")], "chrom string, strand string")
    assert tuples(coverage.strand_reads(reads, sizes)) == [("c", 2, 1), ("d", 0, 0)]
    sequences = spark.createDataFrame([("s x", "ACgn"), ("s y", "TT"), ("n", "NN")], "header string, seq string")
    assert sorted(map(tuple, annotation.gc_content(sequences).collect())) == [("n", 0, None), ("s", 5, 0.4)]
    gtf = spark.createDataFrame([("c", "x", "exon", 5, 9, ".", "+", ".", 'gene_id "g"; transcript_id "t";'), ("c", "x", "exon", 20, 30, ".", "+", ".", 'transcript_id "t"; gene_id "g";'), ("c", "x", "gene", 1, 30, ".", "+", ".", 'gene_id "g";')], formats.GTF)
    assert tuples(annotation.transcript_table(gtf)) == [("g", "t", "c", "+", 4, 30, 2)]


def test_small_tables(spark):
    a, b = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string"), spark.createDataFrame([(None, 1)], "v string, k int")
    assert tuples(samples.common(a, b)) == [(1, None)] and tuples(samples.without(a, b)) == [(2, "x")]
    assert [r[0] for r in a.orderBy("k").select(samples.look_up(F.col("v"), {"x": "found"}, "none")).collect()] == ["none", "none", "found"]
    paths = spark.createDataFrame([("/a/b_c/S1_R1.fq.gz",), ("S2.bam",), ("/a/",)], "p string")
    assert [r[0] for r in paths.select(samples.file_key(F.col("p"))).collect()] == ["S1", "S2", None]
    runs = spark.createDataFrame([("s", ["a_1", "a_2"]), ("s", ["b_1", "b_2"]), ("t", ["c"])], "sample string, fastqs array<string>")
    assert tuples(samples.merge_runs(runs)) == [("s", 1, ["a_1", "b_1"]), ("s", 2, ["a_2", "b_2"]), ("t", 1, ["c"])]


def test_yield_range(spark):
    histogram = spark.createDataFrame([(j, n) for j, n in ((1, 400), (2, 150), (3, 60), (4, 20))], "j long, n_j long")
    rows = dedup.lc_extrap(histogram, steps=3, bootstraps=40).collect()
    assert [r.expected_distinct for r in rows] == [r.expected_distinct for r in dedup.lc_extrap(histogram, steps=3).collect()]
    assert rows == dedup.lc_extrap(histogram, steps=3, bootstraps=40).collect() and all(r.lower <= r.upper for r in rows) and rows[-1].lower < rows[-1].upper


def test_arg_min_takes_the_first(spark):
    tune = spark.createDataFrame([(2, 0.1, "b"), (1, 0.1, "a"), (3, 0.5, "c")], "row_no int, errorRate double, name string")
    assert annotation.first_wins(tune, "errorRate", "row_no").first().name == "a"
    assert transcripts.grid(spark).count() == 63


def test_read_tables(spark):
    reads = spark.createDataFrame([("r", "ACGTACGTGGGGGGGGGGGG", "I" * 20), ("q", "AC", "II")], "name string, seq string, qual string")
    assert tuples(qc.trim(reads, poly="G", least=5, umi=2).select("name", "seq")) == [("r_AC", "GTACGT")]
    assert qc.trim(reads, least=1, complexity=0.5).count() == 1
    assert qc.per_base_quality(reads).where("pos = 0").first().mean == 40.0
    rows = spark.createDataFrame([("r", "ACGTACGT", "IIII!!!!"), ("q", "AC", "!!"), ("s", "ACGTA", "IIIII"), ("t", "", ""), ("u", None, None)], "name string, seq string, qual string")
    assert sorted(((r.name, r.seq, r.qual) for r in qc.trim_quality(rows).collect()), key=str) == [("q", "AC", "!!"), ("r", "ACG", "III"), ("s", "ACGTA", "IIIII"), ("t", "", ""), ("u", None, None)]
    assert tuples(qc.adapter_content(rows, {"x": "GT", "y": "A"})) == [("x", 2, 2, 40.0), ("y", 0, 3, 60.0)]
    many = spark.createDataFrame([(x,) for x, n in (("a", 12), ("b", 2), ("c", 1), ("d", 1)) for _ in range(n)], "seq string")
    assert tuples(qc.duplication_levels(many)) == [(1, 2, 2, 12.5), (2, 1, 2, 12.5), (10, 1, 12, 75.0)]


def test_formats(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">s1 first\nACGT\nAC\n>s2\nGG\n")
    (tmp_path / "x.fq").write_text("@r1 x\nACGT\n+\n@III\n@r2\nAC\n+\nII\n")
    (tmp_path / "x.sam").write_text("@SQ\tSN:c\tLN:9\nr1\t16\tc\t11\t60\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:0\tXX:Z:a:b\n")
    (tmp_path / "x.bed").write_text("#h\ntrack x\na\t1\t5\nb\t2\t3\n")
    assert tuples(formats.read_fasta(spark, str(tmp_path / "x.fa"))) == [("s1 first", "ACGTAC"), ("s2", "GG")]
    assert tuples(formats.read_fastq(spark, str(tmp_path / "x.fq")).select("name", "seq"))[1] == ("r2", "AC")
    (tmp_path / "cut.fq").write_text("@r1 x\nACGT\n+\n@III\n@r2\nAC\n+\n")
    with pytest.raises(Exception, match="lacks lines or letters"):
        formats.read_fastq(spark, str(tmp_path / "cut.fq")).collect()
    (tmp_path / "bad.fq").write_text("@r1 x\nACGT\nACGT\n")
    with pytest.raises(Exception, match="no record of four lines"):
        formats.read_fastq(spark, str(tmp_path / "bad.fq")).collect()
    sam = formats.read_sam(spark, str(tmp_path / "x.sam")).first()
    assert (sam.start, sam.end, sam.strand, sam.tags) == (10, 14, "-", {"NM": "0", "XX": "a:b"})
    beds = formats.read_bed(spark, str(tmp_path / "x.bed"))
    assert tuples(beds) == [("a", 1, 5), ("b", 2, 3)]
    formats.write_bed(beds, str(tmp_path / "out"))
    assert tuples(formats.read_bed(spark, str(tmp_path / "out"))) == tuples(beds)
    gff = spark.createDataFrame([("c", "x", "mRNA", 1, 9, ".", "+", ".", "ID=t1;Parent=g1"), ("c", "x", "exon", 1, 5, ".", "+", ".", "Parent=t1")], formats.GTF)
    assert annotation.gff_to_gtf(gff).first().attributes == 'transcript_id "t1"; gene_id "g1";'


@pytest.mark.parametrize("size", [40, 97, 1 << 20])
def test_fastq_in_splits(spark, tmp_path, size):
    """Splits that end anywhere, qualities that start with '@', empty and long reads, two files."""
    rng, want = np.random.default_rng(size), []
    for file, n in (("a.fastq", 60), ("b.fastq", 25), ("c.fastq.gz", 40)):
        lines = []
        for i in range(n):
            seq = "ACGT" * int(rng.integers(0, 4)) if i != 7 else "A" * 500
            qual = ("@" + "I" * (len(seq) - 1) if i % 3 and seq else "I" * len(seq))
            want.append((f"{file}{i}", seq, qual))
            lines.append(f"@{file}{i} about\n{seq}\n+\n{qual}\n")
        (gzip.open if file.endswith(".gz") else open)(tmp_path / file, "wt").write("".join(lines))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert tuples(formats.read_fastq(spark, str(tmp_path))) == sorted(want)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_stream_equals_batch(spark, tmp_path):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    events.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = sessions.stream_table(spark, str(tmp_path / "in"), events.schema)
    query = sessions.windowed_counts(stream).writeStream.format("memory").queryName("windows").outputMode("complete").start()
    query.processAllAvailable()
    query.stop()
    assert tuples(spark.table("windows").select("event_type", "start", "n")) == tuples(sessions.windowed_counts(events).select("event_type", "start", "n"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_sql_twins(spark, duck, name):
    got, want = catalogue.queries()[name](spark, DATA), duck.sql(catalogue.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    key = lambda rows: sorted(map(repr, rows))
    assert key(tuple(r[c] for c in columns) for r in got.collect()) == key(want.select(*[f'"{c}"' for c in columns]).fetchall())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert os.path.basename(__spark_entry__.__file__) == "__spark_entry__.py"
