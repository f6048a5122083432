"""Every registered query of the interval library, over tables of any size, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import alignment as al
from tidemark.operators import annotation, coverage, dedup, hmm, intervals, mates, qc, quantify, samples, transcripts
from tidemark.sources import bam, formats, proxies, shared
from tidemark.sources.proxies import table
from tidemark.streaming import sessions

_PLACE = "((l_partkey // 10) * 100 + CASE WHEN l_linenumber = 1 THEN 50 ELSE date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) % 100 END)"
READS = f"""reads AS (SELECT concat_ws('/', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS id, l_returnflag || '_REP' || (l_partkey % 2 + 1) AS sample,
  'chr' || (l_partkey % 10) AS chrom, {_PLACE} AS "start", {_PLACE} + CAST(l_quantity AS BIGINT) AS "end",
  CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand, CAST((l_linenumber - 1) * 10 AS BIGINT) AS mapq,
  CAST(1 + 2 * (l_linenumber % 2) + CASE WHEN l_linenumber = 7 THEN 4 ELSE 0 END + CASE WHEN l_linenumber = 6 THEN 8 ELSE 0 END + CASE WHEN l_linestatus = 'F' THEN 0 ELSE 16 END + CASE WHEN l_partkey % 3 = 0 THEN 128 ELSE 64 END + CASE WHEN l_linenumber = 5 THEN 256 ELSE 0 END + CASE WHEN l_partkey % 11 = 0 THEN 1024 ELSE 0 END AS BIGINT) AS flag,
  substr('ACGT', CAST(l_partkey % 4 AS INT) + 1, 1) || substr('ACGT', CAST(l_suppkey % 4 AS INT) + 1, 1) AS umi,
  'chr' || (CASE WHEN l_linenumber = 4 THEN l_suppkey ELSE l_partkey END % 10) AS mate_chrom, {_PLACE} + l_linenumber * 40 - 60 AS mate_start, {_PLACE} + l_linenumber * 40 - 60 + CAST(l_quantity AS BIGINT) AS mate_end,
  CASE WHEN l_linestatus = 'F' THEN '-' ELSE '+' END AS mate_strand, l_quantity, l_extendedprice FROM lineitem)"""
FEATURES = """features AS (SELECT p_partkey AS gene, 'chr' || (p_partkey % 10) AS chrom, (p_partkey // 10) * 100 + p_partkey * 37 % 100 AS "start", (p_partkey // 10) * 100 + p_partkey * 37 % 100 + p_size AS "end",
  CASE WHEN (p_partkey // 10) % 2 = 0 THEN '+' ELSE '-' END AS strand, p_type AS biotype FROM part)"""
REGIONS = """regions AS (SELECT 'chr' || (s_suppkey % 10) AS chrom, (s_suppkey // 10) * 2000 + s_suppkey * 97 % 2000 AS "start", (s_suppkey // 10) * 2000 + s_suppkey * 97 % 2000 + 5 + s_nationkey * 4 AS "end", s_suppkey % 2 = 0 AS keep FROM supplier)"""
SIZES = """sizes AS (SELECT chrom, max("end") AS length FROM reads GROUP BY chrom)"""
OVER = 'a.chrom = b.chrom AND a."start" < b."end" AND b."start" < a."end"'


def _runs(source: str, keys: str = "chrom", value: str = "depth") -> str:
    """Depth runs in SQL."""
    return f"""e AS (SELECT {keys}, "start" AS pos, 1 AS d FROM {source} UNION ALL SELECT {keys}, "end", -1 FROM {source}),
      s AS (SELECT {keys}, pos, sum(d) AS d FROM e GROUP BY ALL HAVING sum(d) <> 0),
      runs AS (SELECT {keys}, pos AS "start", lead(pos) OVER (PARTITION BY {keys} ORDER BY pos) AS "end", CAST(sum(d) OVER (PARTITION BY {keys} ORDER BY pos) AS BIGINT) AS depth FROM s)"""


def _merged(source: str, keys: str = "chrom", name: str = "merged") -> str:
    return f"""{name}_m AS (SELECT {keys}, "start", "end", max("end") OVER (PARTITION BY {keys} ORDER BY "start", "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM {source}),
      {name}_g AS (SELECT *, sum(CASE WHEN pm IS NULL OR "start" > pm THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS g FROM {name}_m),
      {name} AS (SELECT {keys}, min("start") AS "start", max("end") AS "end", count(*) AS n FROM {name}_g GROUP BY {keys}, g)"""


_ENDS = """ends AS (SELECT sample, chrom, strand, CASE WHEN strand = '+' THEN "start" ELSE "end" - 1 END AS pos, umi, mapq, id, l_quantity, l_extendedprice FROM reads)"""
_FLAGS = {
    "total": "TRUE", "secondary": "flag & 256 <> 0", "supplementary": "flag & 2048 <> 0", "duplicates": "flag & 1024 <> 0", "mapped": "flag & 4 = 0",
    "primary": "flag & 2304 = 0", "primary_mapped": "flag & 2308 = 0", "paired": "flag & 2304 = 0 AND flag & 1 <> 0", "read1": "flag & 2304 = 0 AND flag & 1 <> 0 AND flag & 64 <> 0",
    "read2": "flag & 2304 = 0 AND flag & 1 <> 0 AND flag & 128 <> 0", "properly_paired": "flag & 2308 = 0 AND flag & 1 <> 0 AND flag & 2 <> 0",
    "both_mapped": "flag & 2304 = 0 AND flag & 1 <> 0 AND flag & 12 = 0", "singletons": "flag & 2308 = 0 AND flag & 1 <> 0 AND flag & 8 <> 0", "qc_failed": "flag & 512 <> 0",
    "primary_duplicates": "flag & 2304 = 0 AND flag & 1024 <> 0", "mate_elsewhere": "flag & 2304 = 0 AND flag & 1 <> 0 AND flag & 12 = 0 AND mate_chrom <> chrom",
    "mate_elsewhere_mapq5": "flag & 2304 = 0 AND flag & 1 <> 0 AND flag & 12 = 0 AND mate_chrom <> chrom AND mapq >= 5",
}


def _assigned(spark: SparkSession, d: str) -> DataFrame:
    return quantify.assign(proxies.reads(spark, d), proxies.features(spark, d), least_mapq=10, both_ends=True, chimeric=False)


_ASSIGNED = f"""genes AS (SELECT * FROM features),
  r AS (SELECT *, row_number() OVER () AS rid FROM reads),
  hit AS (SELECT a.rid, min(gene) AS low, max(gene) AS high FROM r a JOIN genes b ON {OVER} GROUP BY a.rid),
  assigned AS (SELECT sample, gene, CASE WHEN flag & 4 <> 0 THEN 'Unassigned_Unmapped' WHEN mapq < 10 THEN 'Unassigned_MappingQuality' WHEN flag & 256 <> 0 THEN 'Unassigned_Secondary'
      WHEN flag & 1 <> 0 AND flag & 8 <> 0 THEN 'Unassigned_Singleton' WHEN flag & 1 <> 0 AND mate_chrom <> chrom THEN 'Unassigned_Chimera' WHEN low IS NULL THEN 'Unassigned_NoFeatures' WHEN low <> high THEN 'Unassigned_Ambiguity' ELSE 'Assigned' END AS status
    FROM (SELECT r.*, low, high, low AS gene FROM r LEFT JOIN hit USING (rid)))"""


def _ids(df: DataFrame) -> DataFrame:
    """Rows of the proxies repeat: a number makes each read its own."""
    return df.withColumn("id", F.concat_ws("#", "id", F.monotonically_increasing_id()))


def _sheet(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as a sample sheet: a nation's suppliers are its runs."""
    rows = table(spark, d, "supplier").join(F.broadcast(table(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.selectExpr("n_name AS sample", "concat('run', s_suppkey, CASE WHEN s_suppkey % 17 = 0 THEN '.txt' ELSE '.fastq.gz' END) AS fastq_1", "CASE WHEN n_nationkey % 2 = 0 THEN concat('run', s_suppkey, '_2.fq.gz') END AS fastq_2")


_SHEET = """sheet AS (SELECT n_name AS sample, 'run' || s_suppkey || CASE WHEN s_suppkey % 17 = 0 THEN '.txt' ELSE '.fastq.gz' END AS fastq_1,
  CASE WHEN n_nationkey % 2 = 0 THEN 'run' || s_suppkey || '_2.fq.gz' END AS fastq_2 FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def _calls(spark: SparkSession, d: str) -> DataFrame:
    """Merged reads as transcript calls."""
    merged = intervals.merge_intervals(proxies.reads(spark, d), ("chrom", "strand"))
    return merged.withColumn("id", F.concat_ws(":", "chrom", "strand", "start"))


_CALLS = _merged("reads", "chrom, strand", "calls")


def _tuning(spark: SparkSession, d: str) -> DataFrame:
    """Transcripts called with every pair of parameters, each evaluated against the genes."""
    counts = coverage.binned(proxies.reads(spark, d), 10)
    return transcripts.tune(counts, proxies.features(spark, d), transcripts.grid(spark), 10)


_STAY, _LEAVE = (int(hmm.scores(np.array(x))) for x in hmm.moves(-5.0))


def _viterbi_sql(params: str, more: str = "") -> str:
    """Paths of two states by a recursion over bins, for every row of params (k, stay, leave, variance): called (k, chrom, strand, start, end)."""
    score = lambda x: f"CAST(round(greatest({x}, {hmm.LEAST_SCORE}) * {hmm.UNIT}) AS BIGINT)"
    return f"""RECURSIVE {READS}, {more} params AS ({params}),
      counts AS (SELECT chrom, strand, "start" // 10 AS bin, count(*) AS n FROM reads GROUP BY ALL),
      mean AS (SELECT avg(n) AS m FROM counts),
      o AS (SELECT *, CASE WHEN coalesce(bin - lag(bin) OVER (PARTITION BY chrom, strand ORDER BY bin) > 200, TRUE) THEN bin END AS opens FROM counts),
      s AS (SELECT *, max(opens) OVER (PARTITION BY chrom, strand ORDER BY bin ROWS UNBOUNDED PRECEDING) AS stretch FROM o),
      w AS (SELECT chrom, strand, stretch, unnest(generate_series(0, length)) AS x FROM (SELECT chrom, strand, stretch, max(bin) - stretch + 2 AS length FROM s GROUP BY chrom, strand, stretch)),
      e AS MATERIALIZED (SELECT k, w.chrom, w.strand, w.stretch, x, stay, leave, {score("0.5 * ln(2 / (pi() * variance)) - coalesce(n, 0) * coalesce(n, 0) / (2 * variance)")} AS quiet, {score("-ln(m) - coalesce(n, 0) / m")} AS loud
        FROM w CROSS JOIN params CROSS JOIN mean LEFT JOIN s ON s.chrom = w.chrom AND s.strand = w.strand AND s.stretch = w.stretch AND s.bin = w.stretch - 1 + x),
      lasts AS (SELECT chrom, strand, stretch, max(x) AS last FROM w GROUP BY ALL),
      v AS (SELECT k, chrom, strand, stretch, x, quiet AS a, loud + leave AS b, FALSE AS to0, FALSE AS to1 FROM e WHERE x = 0
        UNION ALL SELECT e.k, e.chrom, e.strand, e.stretch, e.x, greatest(a + stay, b + leave) + quiet, greatest(b + stay, a + leave) + loud, b + leave > a + stay, b + stay >= a + leave
        FROM v JOIN e ON e.k = v.k AND e.chrom = v.chrom AND e.strand = v.strand AND e.stretch = v.stretch AND e.x = v.x + 1),
      t AS (SELECT k, chrom, strand, stretch, x, b > a AS state FROM v JOIN lasts USING (chrom, strand, stretch) WHERE x = last
        UNION ALL SELECT t.k, t.chrom, t.strand, t.stretch, t.x - 1, CASE WHEN t.state THEN to1 ELSE to0 END
        FROM t JOIN v ON v.k = t.k AND v.chrom = t.chrom AND v.strand = t.strand AND v.stretch = t.stretch AND v.x = t.x WHERE t.x > 0),
      i AS (SELECT *, x - row_number() OVER (PARTITION BY k, chrom, strand, stretch ORDER BY x) AS island FROM t WHERE state),
      called AS (SELECT k, chrom, strand, (stretch - 1 + min(x)) * 10 AS "start", (stretch + max(x)) * 10 AS "end" FROM i GROUP BY k, chrom, strand, stretch, island)"""


def _tuned_sql() -> str:
    grid = [(p, u) for p in range(-100, -401, -50) for u in range(5, 46, 5)]
    rows = ", ".join(f"({n}, {', '.join(str(int(hmm.scores(np.array(x)))) for x in hmm.moves(float(p)))}, CAST({u} AS DOUBLE))" for n, (p, u) in enumerate(grid))
    return f"""WITH {_viterbi_sql(f"SELECT * FROM (VALUES {rows}) AS g(k, stay, leave, variance)", f"{FEATURES},")},
      pairs AS (SELECT DISTINCT a.k, a.chrom, a.strand, a."start" AS s, b.gene FROM called a JOIN features b ON {OVER} AND a.strand = b.strand),
      m AS (SELECT k, count(*) FILTER (n > 1) AS merged FROM (SELECT k, count(DISTINCT gene) AS n FROM pairs GROUP BY k, chrom, strand, s) GROUP BY k),
      q AS (SELECT k, CAST(sum(n - 1) AS BIGINT) AS dissociated FROM (SELECT k, gene, count(*) AS n FROM pairs GROUP BY ALL) GROUP BY k),
      z AS (SELECT k, count(*) AS tx_size FROM called GROUP BY k),
      tuned AS (SELECT CAST(-100 - 50 * (k // 9) AS INT) AS LtProbB, CAST(5 + 5 * (k % 9) AS INT) AS UTS, CAST(k AS BIGINT) AS row_no, CASE WHEN tx_size > 0 THEN coalesce(merged, 0) END AS merged, CASE WHEN tx_size > 0 THEN coalesce(dissociated, 0) END AS dissociated,
        CASE WHEN tx_size > 0 THEN coalesce(merged, 0) + coalesce(dissociated, 0) END AS total, round((coalesce(merged, 0) + coalesce(dissociated, 0)) / (tx_size + (SELECT count(*) FROM features)), 6) AS error_rate, tx_size
        FROM params LEFT JOIN z USING (k) LEFT JOIN m USING (k) LEFT JOIN q USING (k))"""


def _best(spark: SparkSession, d: str) -> DataFrame:
    return annotation.first_wins(_tuning(spark, d).where("error_rate IS NOT NULL"), "error_rate", "row_no")


def _paired(spark: SparkSession, d: str, assay: str) -> DataFrame:
    """Reads by the 5' end that counts, of first mates in proper pairs."""
    reads = proxies.reads(spark, d).where(al.has(F.col("flag"), al.PROPER) & al.has(F.col("flag"), al.FIRST)).withColumn("p", al.end_of_pair(assay))
    return reads.groupBy("chrom", "p.strand", "p.start", "p.end").agg(F.count(F.lit(1)).alias("n"))


def _paired_sql(mate: str) -> str:
    return f"""WITH {READS}, x AS (SELECT chrom, {mate}strand AS strand, CASE WHEN {mate}strand = '+' THEN "{mate}start" ELSE "{mate}end" - 1 END AS "start" FROM reads WHERE flag & 2 <> 0 AND flag & 64 <> 0)
        SELECT chrom, strand, "start", "start" + 1 AS "end", count(*) AS n FROM x GROUP BY ALL"""


def _ends(spark: SparkSession, d: str) -> DataFrame:
    return dedup.by_position(proxies.reads(spark, d))


def _peaks(spark: SparkSession, d: str, inflated: bool = False) -> DataFrame:
    return transcripts.tss_peaks(_ends(spark, d).groupBy("chrom", "strand", "pos").agg(F.count(F.lit(1)).alias("n")), inflated=inflated)


_ZERO_INFLATED = """near AS (SELECT chrom, strand, pos, n, greatest(mean, 0.01, CASE WHEN mean > 0 THEN squares / mean - 1 END) AS rate
        FROM (SELECT *, (sum(n) OVER w - n) / 200.0 AS mean, (sum(n * n) OVER w - n * n) / 200.0 AS squares FROM ends WINDOW w AS (PARTITION BY chrom, strand ORDER BY pos RANGE BETWEEN 100 PRECEDING AND 100 FOLLOWING))),"""


_PEAKS = f"""ends AS (SELECT chrom, strand, CASE WHEN strand = '+' THEN "start" ELSE "end" - 1 END AS pos, count(*) AS n FROM reads GROUP BY ALL),
      near AS (SELECT *, greatest((sum(n) OVER (PARTITION BY chrom, strand ORDER BY pos RANGE BETWEEN 100 PRECEDING AND 100 FOLLOWING) - n) / 200.0, 0.01) AS rate FROM ends),
      tested AS (SELECT chrom, strand, pos, n, round(CASE WHEN n > rate THEN list_sum(list_transform(generate_series(n, n + 400), lambda x: exp(x * ln(rate) - rate - lgamma(x + 1.0))))
        ELSE 1 - list_sum(list_transform(generate_series(0, n - 1), lambda x: exp(x * ln(rate) - rate - lgamma(x + 1.0)))) END, {transcripts.P_DIGITS}) AS p FROM near),
      ranked AS (SELECT p, count(*) OVER (ORDER BY p RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rank, count(*) OVER () AS total FROM tested),
      cut AS (SELECT max(p) AS low FROM ranked WHERE p <= 0.1 * rank / total),
      peaks AS (SELECT t.* FROM tested t, cut WHERE p <= low),
      kinds AS (SELECT *, CASE WHEN EXISTS (SELECT 1 FROM peaks b WHERE b.chrom = a.chrom AND b.strand <> a.strand AND b.pos BETWEEN a.pos - 300 AND a.pos + 300) THEN 'divergent' ELSE 'unidirectional' END AS kind FROM peaks a)"""


def _bam(spark: SparkSession, d: str) -> DataFrame:
    """Reads written as BAM files and read back by ranges of their blocks."""
    path = shared.new_path(spark, "bam")
    contigs = [(r.chrom, r.length) for r in proxies.sizes(spark, d).collect()]  # the header
    rows = proxies.reads(spark, d).selectExpr("replace(id, ' ', '_') AS name", "flag", "chrom", "start", "`end`", "strand", "mapq", "concat(`end` - start, 'M') AS cigar", "mate_chrom", "greatest(mate_start, 0) AS mate_start", "0 AS tlen", "'*' AS seq", "'*' AS qual", "map('RX', umi) AS tags")
    bam.write_bam(rows, contigs, path)
    return bam.read_bam(spark, path, 1 << 20).selectExpr("name", "CAST(flag AS BIGINT) AS flag", "chrom", "start", "`end`", "strand", "CAST(mapq AS BIGINT) AS mapq", "mate_chrom", "mate_start", "tags['RX'] AS umi")


_LETTERS = "'0123456789abcdef', 'ACGTACGTACGTACGT'"
_FIRST_ADAPTER, _SECOND_ADAPTER = "AGATCGGAAGAGCACACGTCTGAACTCCAGTCAC", "AGATCGGAAGAGCGTCGTGTAGGGAAAGAGTGTA"


def _mates(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of 75 bases from inserts of 42 to 140, which are made of each read's id."""
    rows = proxies.reads(spark, d).selectExpr("id AS name", f"translate(substring(concat(md5(id), md5(concat(id, 'a')), md5(concat(id, 'b')), md5(concat(id, 'c')), md5(concat(id, 'd'))), 1, CAST(40 + 2 * (`end` - start) AS INT)), {_LETTERS}) AS whole")
    pairs = rows.selectExpr("name", f"substring(concat(whole, '{_FIRST_ADAPTER}'), 1, 75) AS seq1", "repeat('I', 75) AS qual1", f"substring(concat(translate(substring(reverse(whole), 1, 75), 'ACGT', 'TGCA'), '{_SECOND_ADAPTER}'), 1, 75) AS seq2", "repeat('I', 75) AS qual2")
    return mates.overlap_mates(pairs).selectExpr("name", "insert", "overlap", "mismatches", "md5(merged_seq) AS merged_md5", "md5(seq1) AS md5_1", "md5(seq2) AS md5_2")


_MATES = f"""whole AS (SELECT id AS name, CAST(40 + 2 * ("end" - "start") AS INT) AS n, substr(translate(md5(id) || md5(id || 'a') || md5(id || 'b') || md5(id || 'c') || md5(id || 'd'), {_LETTERS}), 1, CAST(40 + 2 * ("end" - "start") AS INT)) AS s FROM reads)"""


def _tags(spark: SparkSession, d: str) -> DataFrame:
    """Reads in a directory by contig and bin, and what of them overlaps a region."""
    path = shared.new_path(spark, "tags")
    formats.write_tags(proxies.reads(spark, d).select("id", "chrom", "start", "end", "strand"), path, 4096)
    return formats.read_region(spark, path, "chr3", 150, 900).select("id", F.col("chrom").cast("string").alias("chrom"), "start", "end", "strand")


def _classes(spark: SparkSession, d: str) -> DataFrame:
    f = proxies.features(spark, d)
    return f.select("chrom", "start", "end", F.when(F.col("gene") % 3 == 0, "cds").when(F.col("gene") % 3 == 1, "utr").otherwise("intron").alias("class"), (F.col("gene") % 3).alias("priority"))


_DEAL = "CAST(conv(substring(md5(concat_ws(':', chrom, start, `end`, mapq, umi, sample)), 1, 6), 16, 10) AS BIGINT) % 100"


_ADAPTERS = {"first": "ing", "second": "Licensed", "third": "er "}


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("name"), F.coalesce("text", F.lit("")).alias("seq"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    reads, features, regions, sizes = proxies.reads, proxies.features, proxies.regions, proxies.sizes
    bed = lambda df: df.select("chrom", "start", "end")
    genes = lambda s, d: features(s, d).select("gene", "chrom", "start", "end", "strand")
    c = coverage.coverage
    return {
        "coverage_plus": lambda s, d: c(reads(s, d).where("strand = '+'")),
        "coverage_minus": lambda s, d: c(reads(s, d).where("strand = '-'")),
        "coverage_all": lambda s, d: c(reads(s, d), ("sample", "chrom", "strand")),
        "coverage_scaled": lambda s, d: c(reads(s, d), scale=0.5),
        "coverage_binned50": lambda s, d: coverage.binned(reads(s, d)),
        "coverage_mean_depth": lambda s, d: coverage.mean_depth(reads(s, d)).withColumn("depth", F.round("depth", 6)),
        "end_positions": lambda s, d: reads(s, d).where("mapq > 0").withColumn("p", al.last_base(F.col("start"), F.col("end"), F.col("strand"))).groupBy("chrom", "strand", F.col("p.start").alias("start"), F.col("p.end").alias("end")).agg(F.count(F.lit(1)).alias("n")),
        "dreg_coverage_signed": lambda s, d: coverage.signed(c(reads(s, d).where("mapq > 0").withColumn("p", al.last_base(F.col("start"), F.col("end"), F.col("strand"))).selectExpr("chrom", "strand", "p.start", "p.end"), ("chrom", "strand"))),
        "rna_strand_coverage": lambda s, d: c(reads(s, d).where(al.lacks(F.col("flag"), al.UNMAPPED | al.SECONDARY)).withColumn("strand", al.rna_strand(F.col("flag"))), ("chrom", "strand")),
        "merge_intervals": lambda s, d: intervals.merge_intervals(features(s, d)),
        "merge_by_strand": lambda s, d: intervals.merge_intervals(features(s, d), ("chrom", "strand"), gap=3),
        "sort_bed": lambda s, d: intervals.sort_bed(genes(s, d)),
        "bed_to_saf": lambda s, d: intervals.bed_to_saf(bed(features(s, d))),
        "intersect_wa": lambda s, d: intervals.intersect(genes(s, d), regions(s, d)),
        "intersect_v": lambda s, d: intervals.intersect(genes(s, d), regions(s, d, False), "none"),
        "intersect_u": lambda s, d: intervals.intersect(genes(s, d), regions(s, d), "any"),
        "filter_then_intersect": lambda s, d: intervals.intersect(intervals.intersect(genes(s, d), regions(s, d, False), "none"), regions(s, d)),
        "count_overlaps": lambda s, d: intervals.count_overlaps(genes(s, d), reads(s, d), "gene"),
        "featurecounts_gene": lambda s, d: quantify.counts(_assigned(s, d), genes(s, d), reads(s, d)),
        "featurecounts_summary": lambda s, d: quantify.summary(_assigned(s, d)),
        "featurecounts_predicted": lambda s, d: quantify.summary(quantify.assign(reads(s, d), intervals.bed_to_saf(_calls(s, d)).withColumnRenamed("gene_id", "gene"))),
        "flagstat": lambda s, d: qc.flagstat(reads(s, d)),
        "idxstats": lambda s, d: qc.idxstats(reads(s, d), sizes(s, d)),
        "samtools_stats": lambda s, d: qc.stats(reads(s, d)),
        "bam_stat": lambda s, d: qc.bam_stat(reads(s, d)),
        "metrics_pivot": lambda s, d: qc.metrics_table(qc.stats(reads(s, d)).replace({"reads mapped": "mapped", "reads of quality 0": "mq0", "bases mapped": "bases"}, subset="metric")),
        "pileup_contig": lambda s, d: coverage.per_contig(c(reads(s, d)), sizes(s, d)),
        "pileup_hist": lambda s, d: coverage.depth_histogram(c(reads(s, d))),
        "read_dup_position": lambda s, d: qc.duplication(_ends(s, d), "chrom", "pos", "strand"),
        "read_dup_sequence": lambda s, d: qc.duplication(_texts(s, d), "seq"),
        "infer_experiment": lambda s, d: qc.infer_experiment(_ids(reads(s, d)), features(s, d)),
        "read_distribution": lambda s, d: qc.read_distribution(_ids(reads(s, d)), _classes(s, d)),
        "inner_distance": lambda s, d: qc.inner_distance(reads(s, d)),
        "inner_distance_stats": lambda s, d: qc.inner_distance_stats(reads(s, d)),
        "junction_annotation": lambda s, d: qc.junctions(bed(reads(s, d)), bed(features(s, d))),
        "end_positions_paired_forward": lambda s, d: _paired(s, d, "PROseq"),
        "end_positions_paired": lambda s, d: _paired(s, d, "GROseq"),
        "umi_pairs_exact": lambda s, d: dedup.exact_umis(dedup.by_position(dedup.whole_pairs(reads(s, d))), "id").select("sample", "chrom", "pos", "strand", "umi", "mapq"),
        "positions_to_bed": lambda s, d: annotation.positions_to_bed(features(s, d).selectExpr("concat('p', gene) AS name", "chrom", "start + 1 AS start", "end", "strand", "gene % 7 AS score")),
        "c_curve": lambda s, d: dedup.c_curve(dedup.complexity_histogram(_ends(s, d), "chrom", "pos", "strand")),
        "umi_dedup_exact": lambda s, d: dedup.exact_umis(_ends(s, d), "id").select("sample", "chrom", "pos", "strand", "umi", "mapq"),
        "umi_per_umi_stats": lambda s, d: dedup.per_umi(_ends(s, d)),
        "samplesheet_group": lambda s, d: samples.check_groups(samples.group_samples(_sheet(s, d))).select("id", "single_end", "n_runs", F.array_join("fastqs", ",").alias("fastqs")),
        "samplesheet_validate": lambda s, d: samples.invalid_rows(_sheet(s, d)),
        "replicate_group": lambda s, d: reads(s, d).groupBy(al.group_of(F.col("sample")).alias("group")).agg(F.count_distinct("sample").alias("samples"), F.count(F.lit(1)).alias("reads")),
        "join_remainder_coalesce": lambda s, d: samples.join_remainder(table(s, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.max("o_orderkey").alias("bai")), table(s, d, "customer").selectExpr("c_custkey AS k", "CAST(c_nationkey AS BIGINT) AS csi"), "k").select("k", F.coalesce("bai", "csi").alias("index")),
        "combine_cross": lambda s, d: samples.combine(table(s, d, "supplier").select("s_suppkey"), table(s, d, "region").select("r_name")),
        "mix_union": lambda s, d: samples.mix(bed(features(s, d)), bed(regions(s, d)), bed(regions(s, d, False))),
        "versions_distinct": lambda s, d: table(s, d, "part").select(F.element_at(F.split("p_type", " "), -1).alias("tool"), "p_brand").distinct(),
        "grid_search_argmin": _best,
        "hmm_tuning": _tuning,
        "expressed_features_q05_q95": lambda s, d: transcripts.expressed(genes(s, d), reads(s, d), size=10).select("gene", "width"),
        "hmm_eval_merged_dissociated": lambda s, d: transcripts.evaluate(_calls(s, d), features(s, d)),
        "consensus_annotation": lambda s, d: annotation.consensus(features(s, d).withColumn("gene", F.floor(F.col("gene") / 30)).withColumn("chrom", F.lit("chr1")).withColumn("start", F.col("start") % 60).withColumn("end", F.col("start") + 40)),
        "break_on_genes": lambda s, d: transcripts.break_on_genes(_calls(s, d), features(s, d)),
        "combine_transcripts": lambda s, d: transcripts.combine_by_gene(transcripts.break_on_genes(_calls(s, d), features(s, d)), features(s, d)),
        "tx_density": lambda s, d: transcripts.density(reads(s, d), features(s, d), 10),
        "gtf_to_bed12": lambda s, d: annotation.gtf_to_bed12(proxies.exons(s, d)),
        "gtf_semi_filter": lambda s, d: annotation.keep_known(genes(s, d), regions(s, d).select(F.col("chrom").alias("seqname"))),
        "skip_chromosomes": lambda s, d: annotation.drop_contigs(bed(features(s, d)), ("chr3", "_random", "chr")),
        "chrom_sizes": lambda s, d: annotation.chrom_sizes(table(s, d, "documents").selectExpr("concat(source, ' ', lang) AS header", "coalesce(text, '') AS seq")),
        "fasta_to_gtf": lambda s, d: annotation.fasta_to_gtf(table(s, d, "documents").selectExpr("concat('doc', doc_id, ' ', lang) AS header", "coalesce(text, '') AS seq")),
        "fastqc_per_base": lambda s, d: qc.per_base(_texts(s, d)),
        "fastqc_length_hist": lambda s, d: qc.length_histogram(_texts(s, d)),
        "fastqc_gc_hist": lambda s, d: qc.gc_histogram(_texts(s, d)),
        "fastqc_overrepresented": lambda s, d: qc.overrepresented(_texts(s, d), 0.2),
        "fastqc_duplication": lambda s, d: qc.duplication_levels(_texts(s, d)),
        "fastqc_adapters": lambda s, d: qc.adapter_content(_texts(s, d), _ADAPTERS),
        "fastp_trim_filter": lambda s, d: qc.trim(_texts(s, d), adapter="Licensed", head=1, tail=2, least=100, umi=6).select("name", F.md5("seq").alias("seq_md5"), F.length("seq").cast("long").alias("length")),
        "session_merge_events": lambda s, d: sessions.merge_sessions(table(s, d, "events"), "2 hours").selectExpr("user_id", "unix_timestamp(start) AS start", "unix_timestamp(`end`) AS end", "n", "round(total, 4) AS total"),
        "bam_round_trip": _bam,
        "tag_directory_region": _tags,
        "flagstat_by_quality": lambda s, d: qc.flagstat(reads(s, d).withColumn("flag", F.expr("flag + CASE WHEN mapq = 20 THEN 512 ELSE 0 END")), by_quality=True),
        "infer_experiment_paired": lambda s, d: qc.infer_experiment(_ids(reads(s, d)), features(s, d), paired=True),
        "fastp_overlap": _mates,
        "stream_merge_intervals": lambda s, d: sessions.merge_islands(features(s, d), ("chrom", "strand"), 3),
        "windowed_events": lambda s, d: sessions.windowed_counts(table(s, d, "events")).selectExpr("event_type", "unix_timestamp(start) AS start", "n", "round(total, 4) AS total"),
        "hmm_transcripts": lambda s, d: transcripts.hmm_transcripts(coverage.binned(reads(s, d), 10), 10, log_leave=-5.0),
        "homer_transcripts": lambda s, d: transcripts.dense_transcripts(coverage.binned(reads(s, d), 10), 10, least=50),
        "tss_peaks": _peaks,
        "umi_dedup_directional": lambda s, d: dedup.directional_umis(_ends(s, d)),
        "lc_extrap": lambda s, d: dedup.lc_extrap(dedup.complexity_histogram(_ends(s, d), "chrom", "pos", "strand", "umi")),
        "lc_extrap_range": lambda s, d: dedup.lc_extrap(dedup.complexity_histogram(_ends(s, d), "chrom", "pos", "strand", "umi"), bootstraps=100),
        "junction_saturation": lambda s, d: qc.junction_saturation(reads(s, d), bed(features(s, d)), F.expr(_DEAL)),
        "transcript_integrity": lambda s, d: qc.transcript_integrity(c(reads(s, d)), features(s, d).withColumn("transcript", F.floor(F.col("gene") / 20))),
        "alignment_histograms": lambda s, d: qc.histograms(reads(s, d)),
        "pileup_median": lambda s, d: coverage.median_depth(c(reads(s, d)), sizes(s, d)),
        "pileup_strands": lambda s, d: coverage.strand_reads(reads(s, d), sizes(s, d)),
        "pileup_gc": lambda s, d: annotation.gc_content(table(s, d, "documents").selectExpr("concat(source, ' ', lang) AS header", "coalesce(text, '') AS seq")),
        "transcript_table": lambda s, d: annotation.transcript_table(proxies.exons(s, d).withColumn("attributes", F.expr("""concat('gene_id "g', CAST(substring(transcript_id, 3) AS BIGINT) DIV 4, '"; transcript_id "', transcript_id, '";')"""))),
        "peaks_gather": lambda s, d: transcripts.gather_peaks(transcripts.on_contigs(_ends(s, d).groupBy("chrom", "strand", "pos").count().where("count >= 3"), ("chr",)), 2),
        "tss_peaks_zero_inflated": lambda s, d: _peaks(s, d, inflated=True),
        "tss_bidirectional": lambda s, d: transcripts.bidirectional(_ends(s, d).groupBy("chrom", "strand", "pos").agg(F.count(F.lit(1)).alias("n")).where("n >= 3"), 20),
        "tss_peaks_gather": lambda s, d: transcripts.gather_peaks(_peaks(s, d).where("kind = 'unidirectional'")),
        "featurecounts_groups": lambda s, d: quantify.assign_each(_ids(reads(s, d)), {"genes": features(s, d), "predicted": intervals.bed_to_saf(_calls(s, d)).withColumnRenamed("gene_id", "gene")}, least_mapq=10).groupBy("annotation", "group", "status").agg(F.count(F.lit(1)).alias("n")),
        "set_common": lambda s, d: samples.common(table(s, d, "customer").selectExpr("c_nationkey AS k", "c_mktsegment AS v"), table(s, d, "customer").where("c_acctbal < 0").selectExpr("c_mktsegment AS v", "c_nationkey AS k")),
        "set_without": lambda s, d: samples.without(table(s, d, "customer").selectExpr("c_nationkey AS k", "c_mktsegment AS v"), table(s, d, "customer").where("c_acctbal < 0").selectExpr("c_mktsegment AS v", "c_nationkey AS k")),
        "look_up_default": lambda s, d: table(s, d, "customer").select("c_custkey", samples.look_up(F.col("c_mktsegment"), {"BUILDING": "b", "MACHINERY": "m"}, "other").alias("short")),
        "merge_runs": lambda s, d: samples.merge_runs(_sheet(s, d).select("sample", F.array_compact(F.array("fastq_1", "fastq_2")).alias("fastqs"))).withColumn("files", F.array_join("files", ",")),
    }


def oracle_sql() -> dict[str, str]:
    strand = lambda x: f"(SELECT * FROM reads WHERE strand = '{x}')"
    runs = 'SELECT {k}, "start", "end", {v} AS depth FROM runs WHERE depth <> 0'
    one = """one AS (SELECT chrom, strand, CASE WHEN strand = '+' THEN "start" ELSE "end" - 1 END AS "start", CASE WHEN strand = '+' THEN "start" + 1 ELSE "end" END AS "end" FROM reads WHERE mapq > 0)"""
    genes = 'a.gene, a.chrom, a."start", a."end", a.strand'
    hits = lambda keep: f"SELECT 1 FROM regions b WHERE {OVER} AND {'' if keep else 'NOT '}b.keep"
    annotated = "annotated AS (SELECT * FROM features)"
    pairs = f"pairs AS (SELECT DISTINCT a.chrom, a.strand, a.\"start\" AS s, a.\"end\" AS e, b.gene, b.\"start\" AS b_start FROM calls a JOIN annotated b ON {OVER} AND a.strand = b.strand)"
    broken = f"""{pairs}, first AS (SELECT chrom, strand, s, min(b_start) AS f FROM pairs GROUP BY ALL),
      cuts AS (SELECT DISTINCT p.chrom, p.strand, p.s, p.b_start AS x FROM pairs p JOIN first f ON p.chrom = f.chrom AND p.strand = f.strand AND p.s = f.s WHERE b_start > p.s AND b_start > f),
      edges AS (SELECT chrom, strand, "start" AS s, "start" AS x FROM calls UNION SELECT chrom, strand, s, x FROM cuts),
      broken AS (SELECT chrom || ':' || strand || ':' || s AS id, chrom, strand, x AS "start", coalesce(lead(x) OVER w, e) AS "end", row_number() OVER w AS part
        FROM (SELECT edges.*, calls."end" AS e FROM edges JOIN calls ON edges.chrom = calls.chrom AND edges.strand = calls.strand AND edges.s = calls."start") WINDOW w AS (PARTITION BY chrom, strand, s ORDER BY x))"""
    flags = ", ".join(f"count(*) FILTER ({c}) AS {n}" for n, c in _FLAGS.items())
    metrics = {"reads": "count(*)", "reads mapped": "count(*) FILTER (flag & 4 = 0)", "reads of quality 0": "count(*) FILTER (flag & 2308 = 0 AND mapq = 0)", "bases mapped": 'sum(CASE WHEN flag & 4 = 0 THEN "end" - "start" ELSE 0 END)', "longest": 'max("end" - "start")', "shortest": 'min("end" - "start")'}
    out = {
        "hmm_transcripts": f"""WITH {_viterbi_sql(f"SELECT 0 AS k, {_STAY} AS stay, {_LEAVE} AS leave, CAST(5 AS DOUBLE) AS variance")} SELECT chrom, strand, "start", "end" FROM called""",
        "hmm_tuning": f"{_tuned_sql()} SELECT * FROM tuned",
        "grid_search_argmin": f"{_tuned_sql()} SELECT * FROM tuned WHERE error_rate IS NOT NULL ORDER BY error_rate, row_no LIMIT 1",
        "tss_peaks_zero_inflated": f"WITH {READS}, " + _PEAKS[: _PEAKS.index("near AS")] + _ZERO_INFLATED + " " + _PEAKS[_PEAKS.index("tested AS") :] + " SELECT * FROM kinds",
        "tss_bidirectional": f"""WITH {READS}, ends AS (SELECT chrom, strand, CASE WHEN strand = '+' THEN "start" ELSE "end" - 1 END AS pos, count(*) AS n FROM reads GROUP BY ALL HAVING count(*) >= 3),
            near AS (SELECT a.chrom, a.pos AS minus, b.pos AS plus, a.n + b.n AS reads FROM ends a JOIN ends b ON a.chrom = b.chrom AND a.strand = '-' AND b.strand = '+' AND b.pos BETWEEN a.pos AND a.pos + 20),
            ranked AS (SELECT *, min(plus) OVER (PARTITION BY chrom, minus) AS first, max(minus) OVER (PARTITION BY chrom, plus) AS last FROM near)
            SELECT chrom, minus AS "start", plus + 1 AS "end", minus, plus, reads FROM ranked WHERE plus = first AND minus = last""",
        "tss_peaks": f"WITH {READS}, {_PEAKS} SELECT * FROM kinds",
        "tss_peaks_gather": f"""WITH {READS}, {_PEAKS}, x AS (SELECT chrom, pos AS "start", pos + 1 AS "end" FROM kinds WHERE kind = 'unidirectional'), {_merged("x")} SELECT * FROM merged""",
        "coverage_plus": f"WITH {READS}, {_runs(strand('+'))} {runs.format(k='chrom', v='depth')}",
        "coverage_minus": f"WITH {READS}, {_runs(strand('-'))} {runs.format(k='chrom', v='depth')}",
        "coverage_all": f"WITH {READS}, {_runs('reads', 'sample, chrom, strand')} {runs.format(k='sample, chrom, strand', v='depth')}",
        "coverage_scaled": f"WITH {READS}, {_runs('reads')} {runs.format(k='chrom', v='depth * CAST(0.5 AS DOUBLE)')}",
        "coverage_binned50": f'WITH {READS} SELECT chrom, strand, CAST(floor("start" / 50) AS BIGINT) AS bin, count(*) AS n FROM reads GROUP BY ALL',
        "coverage_mean_depth": f'WITH {READS}, x AS (SELECT chrom, "start", "end", unnest(range("start" // 50, ("end" - 1) // 50 + 1)) AS bin FROM reads) SELECT chrom, bin, round(sum(least("end", (bin + 1) * 50) - greatest("start", bin * 50)) / 50, 6) AS depth FROM x GROUP BY ALL',
        "end_positions": f'WITH {READS}, {one} SELECT chrom, strand, "start", "end", count(*) AS n FROM one GROUP BY ALL',
        "dreg_coverage_signed": f"WITH {READS}, {one}, {_runs('one', 'chrom, strand')} " + runs.format(k="chrom, strand", v="CASE WHEN strand = '-' THEN -depth ELSE depth END"),
        "rna_strand_coverage": f"WITH {READS}, x AS (SELECT chrom, CASE WHEN (flag & 128 <> 0) = (flag & 16 <> 0) THEN '+' ELSE '-' END AS strand, \"start\", \"end\" FROM reads WHERE flag & 260 = 0), {_runs('x', 'chrom, strand')} {runs.format(k='chrom, strand', v='depth')}",
        "merge_intervals": f"WITH {FEATURES}, {_merged('features')} SELECT * FROM merged",
        "fastp_overlap": f"""WITH {READS}, {_MATES} SELECT name, CASE WHEN n <= 120 THEN n END AS insert, CASE WHEN n <= 75 THEN n WHEN n <= 120 THEN 150 - n END AS overlap, CASE WHEN n <= 120 THEN 0 END AS mismatches, CASE WHEN n <= 120 THEN md5(s) END AS merged_md5,
            md5(substr(s, 1, 75)) AS md5_1, md5(substr(reverse(translate(s, 'ACGT', 'TGCA')), 1, 75)) AS md5_2 FROM whole""",
        "tag_directory_region": f"""WITH {READS} SELECT id, chrom, "start", "end", strand FROM reads WHERE chrom = 'chr3' AND "start" < 900 AND "end" > 150""",
        "flagstat_by_quality": f"WITH {READS} SELECT sample, " + ", ".join(f"count(*) FILTER ({c} AND {'NOT ' if which == 'passed' else ''}(mapq = 20)) AS {n}_{which}" for n, c in _FLAGS.items() if n != "qc_failed" for which in ("passed", "failed")) + " FROM reads GROUP BY sample",
        "infer_experiment_paired": f"""WITH {READS}, {FEATURES}, r AS (SELECT *, row_number() OVER () AS rid FROM reads), o AS (SELECT a.rid, min(b.strand) AS low, max(b.strand) AS high FROM r a JOIN features b ON {OVER} GROUP BY a.rid),
            k AS (SELECT sample, CASE WHEN low <> high THEN 'undetermined' ELSE (CASE WHEN flag & 64 <> 0 THEN '1' ELSE '2' END) || strand || low END AS class FROM r JOIN o USING (rid)), c AS (SELECT sample, class, count(*) AS n FROM k GROUP BY ALL)
            SELECT sample, class, n, round(n / sum(n) OVER (PARTITION BY sample), 6) AS fraction FROM c""",
        "bam_round_trip": f"""WITH {READS} SELECT replace(id, ' ', '_') AS name, flag, chrom, "start", "end", strand, mapq, mate_chrom, greatest(mate_start, 0) AS mate_start, umi FROM reads""",
        "stream_merge_intervals": f"WITH {FEATURES}, {_merged('features', 'chrom, strand').replace('> pm ', '> pm + 3 ')} SELECT * FROM merged",
        "merge_by_strand": f"WITH {FEATURES}, {_merged('features', 'chrom, strand').replace('> pm ', '> pm + 3 ')} SELECT * FROM merged",
        "sort_bed": f'WITH {FEATURES} SELECT {genes} FROM features a ORDER BY chrom, "start", "end"',
        "bed_to_saf": f"""WITH {FEATURES} SELECT chrom || '.' || "start" || '.' || "end" AS gene_id, chrom, "start", "end", '.' AS strand FROM features""",
        "intersect_wa": f"WITH {FEATURES}, {REGIONS} SELECT {genes} FROM features a JOIN regions b ON {OVER} AND b.keep",
        "intersect_v": f"WITH {FEATURES}, {REGIONS} SELECT {genes} FROM features a WHERE NOT EXISTS ({hits(False)})",
        "intersect_u": f"WITH {FEATURES}, {REGIONS} SELECT {genes} FROM features a WHERE EXISTS ({hits(True)})",
        "filter_then_intersect": f"WITH {FEATURES}, {REGIONS} SELECT {genes} FROM features a JOIN regions b ON {OVER} AND b.keep WHERE NOT EXISTS ({hits(False).replace('regions b', 'regions c').replace('b.', 'c.')})",
        "count_overlaps": f"WITH {READS}, {FEATURES} SELECT gene, count(b.id) AS n FROM features a LEFT JOIN reads b ON {OVER} GROUP BY gene",
        "featurecounts_gene": f"WITH {READS}, {FEATURES}, {_ASSIGNED} SELECT g.gene, CAST(g.\"end\" - g.\"start\" AS BIGINT) AS length, s.sample, count(a.gene) AS n FROM genes g CROSS JOIN (SELECT DISTINCT sample FROM reads) s LEFT JOIN assigned a ON a.gene = g.gene AND a.sample = s.sample AND status = 'Assigned' GROUP BY ALL",
        "featurecounts_summary": f"WITH {READS}, {FEATURES}, {_ASSIGNED} SELECT sample, status, count(*) AS n FROM assigned GROUP BY ALL",
        "featurecounts_predicted": f"""WITH {READS}, {_CALLS}, flat AS (SELECT chrom, "start", "end", chrom || '.' || "start" || '.' || "end" AS gene FROM calls), r AS (SELECT *, row_number() OVER () AS rid FROM reads),
            hit AS (SELECT a.rid, min(gene) AS low, max(gene) AS high FROM r a JOIN flat b ON {OVER} GROUP BY a.rid)
            SELECT sample, CASE WHEN flag & 4 <> 0 THEN 'Unassigned_Unmapped' WHEN flag & 256 <> 0 THEN 'Unassigned_Secondary' WHEN low IS NULL THEN 'Unassigned_NoFeatures' WHEN low <> high THEN 'Unassigned_Ambiguity' ELSE 'Assigned' END AS status, count(*) AS n
            FROM r LEFT JOIN hit USING (rid) GROUP BY ALL""",
        "flagstat": f"WITH {READS} SELECT sample, {flags} FROM reads GROUP BY sample",
        "idxstats": f"WITH {READS}, {SIZES} SELECT chrom, length, count(*) FILTER (flag & 4 = 0) AS mapped, count(*) FILTER (flag & 4 <> 0) AS unmapped FROM sizes JOIN reads USING (chrom) GROUP BY ALL UNION ALL SELECT '*', 0, 0, 0",
        "samtools_stats": f"WITH {READS} " + " UNION ALL ".join(f"SELECT sample, '{m}' AS metric, CAST({e} AS DOUBLE) AS value FROM reads GROUP BY sample" for m, e in metrics.items()),
        "bam_stat": f"""WITH {READS} SELECT sample, count(*) FILTER (flag & 4 <> 0) AS unmapped, count(*) FILTER (flag & 2304 <> 0 AND flag & 4 = 0) AS non_primary, count(*) FILTER (flag & 3844 = 0 AND mapq < 30) AS non_unique,
            count(*) FILTER (flag & 3844 = 0 AND mapq >= 30) AS "unique", count(*) FILTER (flag & 3860 = 0 AND mapq >= 30) AS unique_plus, count(*) FILTER (flag & 3844 = 0 AND flag & 16 <> 0 AND mapq >= 30) AS unique_minus, count(*) FILTER (flag & 3844 = 0 AND flag & 2 <> 0 AND mapq >= 30) AS proper FROM reads GROUP BY sample""",
        "metrics_pivot": f"WITH {READS} SELECT sample, " + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in zip(("reads", "mapped", "mq0", "bases", "longest", "shortest"), metrics.values(), strict=True)) + " FROM reads GROUP BY sample",
        "pileup_contig": f"""WITH {READS}, {SIZES}, {_runs('reads')}, x AS (SELECT chrom, CAST(sum("end" - "start") AS BIGINT) AS covered, sum(("end" - "start") * depth) AS s, sum(("end" - "start") * depth * depth) AS ss FROM runs WHERE depth <> 0 GROUP BY chrom)
            SELECT chrom, length, covered, round(100 * covered / length, 6) AS covered_percent, round(s / length, 6) AS mean_depth, round(sqrt(greatest(ss / length - (s / length) * (s / length), 0)), 6) AS sd_depth FROM sizes JOIN x USING (chrom)""",
        "pileup_hist": f'WITH {READS}, {_runs("reads")} SELECT depth, CAST(sum("end" - "start") AS BIGINT) AS bases FROM runs WHERE depth <> 0 GROUP BY depth',
        "read_dup_position": f"WITH {READS}, {_ENDS} SELECT occurrence, count(*) AS n FROM (SELECT count(*) AS occurrence FROM ends GROUP BY chrom, pos, strand) GROUP BY ALL",
        "read_dup_sequence": "SELECT occurrence, count(*) AS n FROM (SELECT count(*) AS occurrence FROM documents GROUP BY coalesce(text, '')) GROUP BY ALL",
        "infer_experiment": f"""WITH {READS}, {FEATURES}, r AS (SELECT *, row_number() OVER () AS rid FROM reads), x AS (SELECT a.rid, a.sample, a.strand, min(b.strand) AS low, max(b.strand) AS high FROM r a JOIN features b ON {OVER} GROUP BY ALL),
            y AS (SELECT sample, CASE WHEN low <> high THEN 'undetermined' ELSE strand || low END AS class, count(*) AS n FROM x GROUP BY ALL) SELECT sample, class, n, round(n / sum(n) OVER (PARTITION BY sample), 6) AS fraction FROM y""",
        "read_distribution": f"""WITH {READS}, {FEATURES}, r AS (SELECT chrom, ("start" + "end") // 2 AS p, row_number() OVER () AS rid FROM reads), x AS (SELECT rid, min(gene % 3) AS k FROM r JOIN features f ON r.chrom = f.chrom AND p >= f."start" AND p < f."end" GROUP BY rid)
            SELECT CASE k WHEN 0 THEN 'cds' WHEN 1 THEN 'utr' WHEN 2 THEN 'intron' ELSE 'intergenic' END AS class, count(*) AS n FROM r LEFT JOIN x USING (rid) GROUP BY ALL""",
        "inner_distance": f'WITH {READS}, x AS (SELECT mate_start - "end" AS gap FROM reads) SELECT CAST(floor((gap + 250) / 5) * 5 - 250 AS BIGINT) AS bin, count(*) AS n FROM x WHERE gap BETWEEN -250 AND 249 GROUP BY ALL',
        "inner_distance_stats": f'WITH {READS}, x AS (SELECT sample, mate_start - "end" AS gap FROM reads) SELECT sample, count(*) AS n, round(avg(gap), 6) AS mean, round(median(gap), 6) AS "median", round(stddev_samp(gap), 6) AS sd FROM x GROUP BY sample',
        "junction_annotation": f"""WITH {READS}, {FEATURES}, x AS (SELECT chrom, "start", "end", count(*) AS reads FROM reads GROUP BY ALL)
            SELECT *, CASE WHEN EXISTS (SELECT 1 FROM features f WHERE f.chrom = x.chrom AND f."start" = x."start" AND f."end" = x."end") THEN 'annotated'
              WHEN EXISTS (SELECT 1 FROM features f WHERE f.chrom = x.chrom AND f."start" = x."start") OR EXISTS (SELECT 1 FROM features f WHERE f.chrom = x.chrom AND f."end" = x."end") THEN 'partial_novel' ELSE 'complete_novel' END AS class FROM x""",
        "end_positions_paired_forward": _paired_sql(""),
        "end_positions_paired": _paired_sql("mate_"),
        "umi_pairs_exact": f"WITH {READS}, kept AS (SELECT * FROM reads WHERE flag & 1 <> 0 AND flag & 8 = 0 AND mate_chrom = chrom), {_ENDS.replace('FROM reads', 'FROM kept')} SELECT sample, chrom, pos, strand, umi, max(mapq) AS mapq FROM ends GROUP BY ALL",
        "positions_to_bed": f"""WITH {FEATURES} SELECT chrom, "start", "end", 'p' || gene AS name, gene % 7 AS score, strand FROM features""",
        "c_curve": f"""WITH {READS}, {_ENDS}, h AS (SELECT j, count(*) AS n_j FROM (SELECT count(*) AS j FROM ends GROUP BY chrom, pos, strand) GROUP BY j)
            SELECT step, CAST(floor(sum(j * n_j) * (step / 10)) AS BIGINT) AS total_reads, round(sum(n_j * (1 - pow(1 - step / 10, j))), 4) AS distinct FROM h CROSS JOIN (SELECT unnest(range(1, 11)) AS step) GROUP BY step""".replace("AS distinct", 'AS "distinct"'),
        "umi_dedup_exact": f"WITH {READS}, {_ENDS} SELECT sample, chrom, pos, strand, umi, max(mapq) AS mapq FROM ends GROUP BY ALL",
        "umi_per_umi_stats": f"WITH {READS}, {_ENDS}, x AS (SELECT umi, count(*) AS n FROM ends GROUP BY sample, chrom, pos, strand, umi) SELECT umi, count(*) AS places, CAST(sum(n) AS BIGINT) AS reads, max(n) AS most FROM x GROUP BY umi",
        "samplesheet_group": f"""WITH {_SHEET}, x AS (SELECT sample, fastq_2 IS NULL AS single_end, fastq_1 || CASE WHEN fastq_2 IS NULL THEN '' ELSE ',' || fastq_2 END AS f, fastq_1 FROM sheet)
            SELECT sample AS id, bool_and(single_end) AS single_end, count(*) AS n_runs, string_agg(f, ',' ORDER BY fastq_1) AS fastqs FROM x GROUP BY sample""",
        "samplesheet_validate": rf"""WITH {_SHEET} SELECT sample, 'fastq_1 must be given and end in .fastq.gz or .fq.gz' AS reason FROM sheet WHERE NOT regexp_matches(fastq_1, '^\S+\.f(ast)?q\.gz$')
            UNION ALL SELECT sample, 'sample must be given without spaces' FROM sheet WHERE NOT regexp_matches(sample, '^\S+$')""",
        "replicate_group": f"WITH {READS} SELECT split_part(sample, '_', 1) AS \"group\", count(DISTINCT sample) AS samples, count(*) AS reads FROM reads GROUP BY ALL",
        "join_remainder_coalesce": 'SELECT coalesce(a.k, b.k) AS k, coalesce(bai, csi) AS "index" FROM (SELECT o_custkey AS k, max(o_orderkey) AS bai FROM orders GROUP BY 1) a FULL JOIN (SELECT c_custkey AS k, CAST(c_nationkey AS BIGINT) AS csi FROM customer) b ON a.k = b.k',
        "combine_cross": "SELECT s_suppkey, r_name FROM supplier CROSS JOIN region",
        "mix_union": f'WITH {FEATURES}, {REGIONS} SELECT chrom, "start", "end" FROM features UNION ALL SELECT chrom, "start", "end" FROM regions',
        "versions_distinct": "SELECT DISTINCT string_split(p_type, ' ')[-1] AS tool, p_brand FROM part",
        "expressed_features_q05_q95": f"""WITH {READS}, {FEATURES}, f AS (SELECT *, "end" - "start" AS width, CASE WHEN strand = '-' THEN greatest("start", "end" - 10) ELSE "start" END AS s, CASE WHEN strand = '-' THEN "end" ELSE least("end", "start" + 10) END AS e FROM features),
            x AS (SELECT gene, width FROM f WHERE EXISTS (SELECT 1 FROM reads r WHERE r.chrom = f.chrom AND r."start" < f.e AND f.s < r."end"))
            SELECT gene, width FROM x WHERE width > (SELECT quantile_cont(width, 0.05) FROM x) AND width < (SELECT quantile_cont(width, 0.95) FROM x)""",
        "hmm_eval_merged_dissociated": f"""WITH {READS}, {FEATURES}, {_CALLS}, {annotated}, {pairs}, m AS (SELECT count(*) FILTER (n > 1) AS merged FROM (SELECT count(DISTINCT gene) AS n FROM pairs GROUP BY chrom, strand, s)), q AS (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS dissociated FROM (SELECT count(*) AS n FROM (SELECT DISTINCT gene, chrom, strand, s FROM pairs) GROUP BY gene))
            SELECT merged, dissociated, merged + dissociated AS total, round((merged + dissociated) / ((SELECT count(*) FROM calls) + (SELECT count(*) FROM annotated)), 6) AS error_rate, (SELECT count(*) FROM calls) AS tx_size FROM m CROSS JOIN q""",
        "consensus_annotation": f"""WITH {FEATURES}, t AS (SELECT gene // 30 AS gene, 'chr1' AS chrom, strand, "start" % 60 AS s FROM features), x AS (SELECT gene, chrom, strand, max(s) AS i, min(s + 40) AS j, min(s) AS lo, max(s + 40) AS hi FROM t GROUP BY ALL)
            SELECT gene, chrom, strand, CASE WHEN i < j THEN i ELSE lo END AS "start", CASE WHEN i < j THEN j ELSE hi END AS "end" FROM x""",
        "break_on_genes": f"WITH {READS}, {FEATURES}, {_CALLS}, {annotated}, {broken} SELECT * FROM broken",
        "combine_transcripts": f"""WITH {READS}, {FEATURES}, {_CALLS}, {annotated}, {broken}, of AS (SELECT a.id, a.part, arg_min(b.gene, b."start" * 1000000 + b.gene) AS gene FROM broken a JOIN annotated b ON {OVER} AND a.strand = b.strand GROUP BY ALL)
            SELECT chrom, strand, min("start") AS "start", max("end") AS "end", count(*) AS n FROM broken LEFT JOIN of USING (id, part) GROUP BY chrom, strand, coalesce('g' || gene, 'p' || id || '.' || part)""",
        "tx_density": f"""WITH {READS}, {FEATURES}, f AS (SELECT * FROM features), p AS (SELECT chrom, strand, CASE WHEN strand = '+' THEN "start" ELSE "end" - 1 END AS pos FROM reads)
            SELECT CAST(CASE WHEN p.strand = '-' THEN f."end" - 1 - pos ELSE pos - f."start" END * 10 // (f."end" - f."start") AS BIGINT) AS bin, count(*) AS n, round(count(*) / (SELECT count(*) FROM f), 6) AS per_feature
            FROM p JOIN f ON p.chrom = f.chrom AND p.strand = f.strand AND pos >= f."start" AND pos < f."end" GROUP BY 1""",
        "gtf_to_bed12": """WITH x AS (SELECT 'tx' || l_orderkey AS id, CAST(l_linenumber AS HUGEINT) * 1000000000000 + l_partkey * 1000000 + CAST(trunc(l_extendedprice) AS BIGINT) AS line_no, 'chr' || (l_orderkey % 10) AS chrom,
              CASE WHEN l_linenumber = 6 THEN 'start_codon' WHEN l_linenumber = 7 THEN 'stop_codon' ELSE 'exon' END AS feature, CAST(l_orderkey % 1000 + l_linenumber * 100 + l_partkey % 40 AS BIGINT) AS s,
              CAST(l_orderkey % 1000 + l_linenumber * 100 + l_partkey % 40 + CASE WHEN l_linenumber > 5 THEN 2 ELSE CAST(l_quantity AS BIGINT) END AS BIGINT) AS e, CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM lineitem),
            c AS (SELECT id, arg_max(s, line_no) FILTER (feature = 'start_codon') AS first, arg_max(e, line_no) FILTER (feature = 'stop_codon') AS last FROM x GROUP BY id),
            t AS (SELECT id, chrom, strand, min(s) AS beg, arg_max(e, s * 1000000000000000000 + line_no) AS stop, count(*) AS k, string_agg(e - s + 1, ',' ORDER BY s, line_no, e) || ',' AS sizes, list(s ORDER BY s, line_no, e) AS ss FROM (SELECT *, CAST(s AS HUGEINT) AS s_ FROM x WHERE feature = 'exon') GROUP BY ALL)
            SELECT chrom, beg - 1 AS "start", stop AS "end", id AS name, 0 AS score, strand, coalesce(CASE WHEN strand = '-' THEN last - 2 ELSE first END, beg) - 1 AS thick_start, coalesce(CASE WHEN strand = '-' THEN first + 2 ELSE last END, stop) AS thick_end, 0 AS rgb, k AS block_count, sizes AS block_sizes,
              array_to_string(list_transform(ss, lambda v: v - beg), ',') || ',' AS block_starts FROM t JOIN c USING (id)""".replace("s * 1000000000000000000", "CAST(s AS HUGEINT) * 1000000000000000000"),
        "gtf_semi_filter": f"WITH {FEATURES}, {REGIONS} SELECT {genes} FROM features a WHERE chrom IN (SELECT chrom FROM regions WHERE keep)",
        "skip_chromosomes": f"WITH {FEATURES} SELECT chrom, \"start\", \"end\" FROM features WHERE chrom NOT IN ('chr3', '_random', 'chr')",
        "chrom_sizes": "SELECT source AS chrom, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS length FROM documents GROUP BY source",
        "fasta_to_gtf": """SELECT 'doc' || doc_id AS chrom, 'transgene' AS source, 'exon' AS feature, CAST(1 AS BIGINT) AS "start", length(coalesce(text, '')) AS "end", '.' AS score, '+' AS strand, '.' AS frame,
            replace('gene_id "X"; gene_name "X"; transcript_id "X"; gene_biotype "X"; gene_type "X"', 'X', 'doc' || doc_id) AS attributes FROM documents""",
        "fastqc_per_base": "SELECT CAST(i - 1 AS INT) AS pos, substr(text, i, 1) AS base, count(*) AS n FROM (SELECT text, unnest(range(1, length(text) + 1)) AS i FROM documents) GROUP BY ALL",
        "fastqc_length_hist": "SELECT length(coalesce(text, '')) AS length, count(*) AS n FROM documents GROUP BY 1",
        "fastqc_gc_hist": "SELECT CAST(round(100 * length(regexp_replace(upper(text), '[^GC]', '', 'g')) / length(text)) AS BIGINT) AS gc, count(*) AS n FROM documents WHERE length(text) > 0 GROUP BY 1",
        "fastqc_duplication": f"""WITH c AS (SELECT count(*) AS n FROM documents GROUP BY coalesce(text, '')), l AS (SELECT list_max(list_filter([{', '.join(map(str, qc.DUPLICATION))}], lambda x: x <= n)) AS level, n FROM c)
            SELECT CAST(level AS BIGINT) AS level, count(*) AS sequences, CAST(sum(n) AS BIGINT) AS reads, round(100 * sum(n) / (SELECT count(*) FROM documents), 6) AS percent FROM l GROUP BY 1""",
        "fastqc_adapters": f"""WITH a(adapter, letters) AS (VALUES {', '.join(f"('{n}', '{x}')" for n, x in _ADAPTERS.items())}),
            f AS (SELECT adapter, CAST(strpos(text, letters) - 1 AS BIGINT) AS pos, count(*) AS n FROM documents, a WHERE strpos(text, letters) > 0 GROUP BY ALL)
            SELECT adapter, pos, n, round(100 * sum(n) OVER (PARTITION BY adapter ORDER BY pos) / (SELECT count(*) FROM documents), 6) AS reached FROM f""",
        "fastqc_overrepresented": "SELECT coalesce(text, '') AS seq, count(*) AS n, round(100 * count(*) / (SELECT count(*) FROM documents), 6) AS percent FROM documents GROUP BY 1 HAVING percent >= 0.2",
        "fastp_trim_filter": "WITH a AS (SELECT CAST(doc_id AS VARCHAR) || '_' || substr(text, 1, 6) AS name, substr(text, 7) AS s FROM documents), b AS (SELECT name, substr(s, 2, greatest(length(s) - 3, 0)) AS s FROM a), c AS (SELECT name, CASE WHEN position('Licensed' IN s) > 0 THEN substr(s, 1, position('Licensed' IN s) - 1) ELSE s END AS s FROM b) SELECT name, md5(s) AS seq_md5, length(s) AS length FROM c WHERE length(s) >= 100",
        "session_merge_events": """WITH x AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts >= lag(ts) OVER w + INTERVAL 2 HOUR THEN 1 ELSE 0 END AS o FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), y AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM x)
            SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS "start", CAST(floor(epoch(max(ts) + INTERVAL 2 HOUR)) AS BIGINT) AS "end", count(*) AS n, round(sum(value), 4) AS total FROM y GROUP BY user_id, g""",
        "umi_dedup_directional": f"""WITH RECURSIVE {READS}, {_ENDS}, c AS (SELECT *, row_number() OVER (PARTITION BY sample, chrom, strand, pos ORDER BY n DESC, umi) AS k FROM (SELECT sample, chrom, strand, pos, umi, count(*) AS n FROM ends GROUP BY ALL)),
            step AS (SELECT a.sample, a.chrom, a.strand, a.pos, a.k AS a, b.k AS b FROM c a JOIN c b USING (sample, chrom, strand, pos) WHERE hamming(a.umi, b.umi) = 1 AND a.n >= 2 * b.n - 1),
            reach AS (SELECT sample, chrom, strand, pos, k AS r, k AS v FROM c UNION SELECT sample, chrom, strand, pos, r, b FROM reach JOIN step USING (sample, chrom, strand, pos) WHERE a = v),
            root AS (SELECT sample, chrom, strand, pos, v, min(r) AS r FROM reach GROUP BY ALL)
            SELECT t.sample, t.chrom, t.strand, t.pos, m.umi, CAST(sum(o.n) AS BIGINT) AS reads, count(*) AS umis FROM root t JOIN c m ON m.sample = t.sample AND m.chrom = t.chrom AND m.strand = t.strand AND m.pos = t.pos AND m.k = t.r
              JOIN c o ON o.sample = t.sample AND o.chrom = t.chrom AND o.strand = t.strand AND o.pos = t.pos AND o.k = t.v GROUP BY ALL""",
        "junction_saturation": f"""WITH {READS}, {FEATURES}, x AS (SELECT chrom, "start", "end", min((CAST('0x' || substr(md5(concat_ws(':', chrom, "start", "end", mapq, umi, sample)), 1, 6) AS BIGINT) % 100 // 5 + 1) * 5) AS p FROM reads GROUP BY ALL),
            y AS (SELECT p, (chrom, "start", "end") IN (SELECT (chrom, "start", "end") FROM features) AS known FROM x)
            SELECT percent, count(*) FILTER (known) AS known, count(*) FILTER (NOT known) AS novel FROM (SELECT unnest(range(5, 101, 5)) AS percent) LEFT JOIN y ON p <= percent GROUP BY percent""",
        "transcript_integrity": f"""WITH {READS}, {FEATURES}, {_runs('reads')}, t AS (SELECT gene // 20 AS transcript, chrom, "start", "end" FROM features), {_merged('t', 'transcript, chrom', 'ex')},
            l AS (SELECT transcript, CAST(sum("end" - "start") AS BIGINT) AS length FROM ex GROUP BY 1),
            x AS (SELECT transcript, least(a."end", b."end") - greatest(a."start", b."start") AS w, depth AS d FROM ex a JOIN runs b ON {OVER} WHERE depth <> 0),
            y AS (SELECT transcript, CAST(sum(w * d) AS BIGINT) AS bases, sum(w * d * ln(d)) AS logs FROM x GROUP BY 1)
            SELECT transcript, length, coalesce(bases, 0) AS bases, round(coalesce(100 * exp(ln(bases) - logs / bases) / length, 0), 6) AS tin FROM l LEFT JOIN y USING (transcript)""",
        "alignment_histograms": f"""WITH {READS}, r AS (SELECT * FROM reads WHERE flag & 2308 = 0)
            SELECT sample, 'read_length' AS section, "end" - "start" AS value, count(*) AS n FROM r GROUP BY ALL UNION ALL SELECT sample, 'mapq', mapq, count(*) FROM r GROUP BY ALL
            UNION ALL SELECT sample, 'insert_size', greatest("end", mate_end) - least("start", mate_start), count(*) FROM r WHERE flag & 2 <> 0 AND flag & 64 <> 0 AND mate_chrom = chrom GROUP BY ALL""",
        "pileup_median": f"""WITH {READS}, {SIZES}, {_runs('reads')}, b AS (SELECT chrom, depth, sum("end" - "start") AS bases FROM runs WHERE depth <> 0 GROUP BY ALL UNION ALL SELECT chrom, 0, length - (SELECT coalesce(sum("end" - "start"), 0) FROM runs WHERE runs.chrom = sizes.chrom AND depth <> 0) FROM sizes),
            u AS (SELECT chrom, depth, sum(bases) OVER (PARTITION BY chrom ORDER BY depth) AS upto FROM b) SELECT chrom, CAST(min(depth) AS BIGINT) AS median_depth FROM u JOIN sizes USING (chrom) WHERE 2 * upto >= length GROUP BY chrom""",
        "pileup_strands": f"WITH {READS} SELECT chrom, count(*) FILTER (strand = '+') AS plus_reads, count(*) FILTER (strand = '-') AS minus_reads FROM reads GROUP BY chrom",
        "pileup_gc": "WITH x AS (SELECT source AS chrom, upper(coalesce(text, '')) AS s FROM documents), y AS (SELECT chrom, CAST(sum(length(regexp_replace(s, '[^ACGT]', '', 'g'))) AS BIGINT) AS bases, sum(length(regexp_replace(s, '[^GC]', '', 'g'))) AS n FROM x GROUP BY 1) SELECT chrom, bases, CASE WHEN bases > 0 THEN round(n / bases, 6) END AS gc FROM y",
        "transcript_table": """SELECT 'g' || (l_orderkey // 4) AS gene_id, 'tx' || l_orderkey AS tx_name, 'chr' || (l_orderkey % 10) AS chrom, CASE WHEN l_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand,
            CAST(min(l_orderkey % 1000 + l_linenumber * 100 + l_partkey % 40) - 1 AS BIGINT) AS "start", CAST(max(l_orderkey % 1000 + l_linenumber * 100 + l_partkey % 40 + CAST(l_quantity AS BIGINT)) AS BIGINT) AS "end", count(*) AS exons FROM lineitem WHERE l_linenumber <= 5 GROUP BY l_orderkey""",
        "peaks_gather": f"""WITH {READS}, {_ENDS}, p AS (SELECT chrom, pos AS "start", pos + 1 AS "end" FROM ends WHERE starts_with(chrom, 'chr') GROUP BY chrom, strand, pos HAVING count(*) >= 3), {_merged('p').replace('> pm ', '> pm + 2 ')} SELECT * FROM merged""",
        "featurecounts_groups": f"""WITH {READS}, {FEATURES}, {_CALLS}, r AS (SELECT *, row_number() OVER () AS rid FROM reads), f AS (SELECT 'genes' AS annotation, chrom, "start", "end", CAST(gene AS VARCHAR) AS gene FROM features UNION ALL SELECT 'predicted', chrom, "start", "end", chrom || '.' || "start" || '.' || "end" FROM calls),
            hit AS (SELECT annotation, rid, min(gene) AS low, max(gene) AS high FROM r a JOIN f b ON {OVER} GROUP BY ALL)
            SELECT n.annotation, split_part(sample, '_', 1) AS "group", CASE WHEN flag & 4 <> 0 THEN 'Unassigned_Unmapped' WHEN mapq < 10 THEN 'Unassigned_MappingQuality' WHEN flag & 256 <> 0 THEN 'Unassigned_Secondary' WHEN low IS NULL THEN 'Unassigned_NoFeatures' WHEN low <> high THEN 'Unassigned_Ambiguity' ELSE 'Assigned' END AS status, count(*) AS n
            FROM r CROSS JOIN (SELECT DISTINCT annotation FROM f) n LEFT JOIN hit ON hit.rid = r.rid AND hit.annotation = n.annotation GROUP BY ALL""",
        "set_common": "SELECT c_nationkey AS k, c_mktsegment AS v FROM customer INTERSECT SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0",
        "set_without": "SELECT c_nationkey AS k, c_mktsegment AS v FROM customer EXCEPT SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < 0",
        "look_up_default": "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'b' WHEN 'MACHINERY' THEN 'm' ELSE 'other' END AS short FROM customer",
        "merge_runs": f"WITH {_SHEET}, x AS (SELECT sample, 1 AS mate, fastq_1 AS file FROM sheet UNION ALL SELECT sample, 2, fastq_2 FROM sheet WHERE fastq_2 IS NOT NULL) SELECT sample, CAST(mate AS BIGINT) AS mate, string_agg(file, ',' ORDER BY file) AS files FROM x GROUP BY sample, mate",
        "windowed_events": 'SELECT event_type, CAST(epoch(date_trunc(\'hour\', ts)) AS BIGINT) AS "start", count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2',
    }
    return out
