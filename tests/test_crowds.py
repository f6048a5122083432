"""Places and intervals that are crowded or long: the same results, dealt over tasks."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import annotation, coverage, dedup, intervals, quantify
from tidemark.streaming import sessions

READS = "sample string, chrom string, pos long, strand string, umi string, mapq int, id string"


def test_crowded_places_cluster_alike(spark):
    """Clustering by joins equals clustering in a task: chains, ties, counts that only just suffice, UMIs of two lengths, a null contig."""
    rng = random.Random(12)
    rows = []
    for at in range(6):
        for _ in range(60):
            umi = "".join(rng.choice("ACGT") for _ in range(3 if at % 2 else 4))
            rows += [("s", None if at == 5 else "c", at, "+", umi, 60, "")] * rng.choice([1, 1, 1, 2, 3, 5, 9, 17])
    rows += [("s", "c", 9, "-", u, 60, "") for u in ("AAAA", "AAAC", "AACC", "ACCC", "CCCC", "AAA", "")]  # a chain of single reads
    table = spark.createDataFrame(rows, READS).repartition(3)
    usual = sorted(map(str, dedup.directional_umis(table).collect()))
    assert sorted(map(str, dedup.directional_umis(table, crowd=1).collect())) == usual
    assert sorted(map(str, dedup.directional_umis(table, crowd=30).collect())) == usual


def test_a_place_of_very_many_umis(spark):
    """20,000 UMIs of one place: as in one task, but no task holds it."""
    rng = random.Random(2)
    umis = list({"".join(rng.choice("ACGT") for _ in range(9)) for _ in range(20_000)})
    rows = [("s", "c", 1, "+", u, 60, "") for u in umis for _ in range(rng.choice([1, 1, 1, 4]))]
    table = spark.createDataFrame(rows, READS)
    got = dedup.directional_umis(table, crowd=10_000)
    counts = {}
    for r in rows:
        counts[r[4]] = counts.get(r[4], 0) + 1
    names = sorted(counts)
    roots = dedup._roots(names, [counts[u] for u in names])
    want = {}
    for u, r in zip(names, roots, strict=True):
        n, k = want.get(names[r], (0, 0))
        want[names[r]] = (n + counts[u], k + 1)
    assert {r.umi: (r.reads, r.umis) for r in got.collect()} == want


def test_streamed_islands(spark, tmp_path):
    """A stream of intervals merges as the table does: nested and book-ended ones, across files, out of order."""
    rng = random.Random(5)
    rows = [(rng.choice("ab"), s, s + rng.choice([1, 5, 40, 300])) for s in (rng.randint(0, 6000) for _ in range(400))] + [("a", 7000, 7010), ("a", 7010, 7020), ("b", 9, 9), (None, 1, 5)]
    schema = "chrom string, start long, end long"
    for gap in (0, 4):
        want = sorted(map(tuple, intervals.merge_intervals(spark.createDataFrame(rows, schema), gap=gap).collect()))
        assert sorted(map(tuple, sessions.merge_islands(spark.createDataFrame(rows, schema), gap=gap).collect())) == want
        folder = str(tmp_path / f"in{gap}")
        for k in range(4):  # each file reaches 2,000 places back
            part = [r for i, r in enumerate(rows) if i % 4 == k]
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        spark.createDataFrame([("z", 100_000, 100_001)], schema).coalesce(1).write.mode("append").parquet(folder)  # moves time on
        spark.createDataFrame([("z", 100_000, 100_001)], schema).coalesce(1).write.mode("append").parquet(folder)
        stream = sessions.merge_islands(sessions.stream_table(spark, folder, schema), gap=gap, late=8000)
        query = stream.writeStream.format("memory").queryName(f"islands{gap}").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert sorted(tuple(r) for r in spark.table(f"islands{gap}").collect() if r.chrom != "z") == want


def test_nested_bins(spark):
    """Genes of whole contigs, deep places and short reads: every pair once, in few rows."""
    rng = random.Random(7)
    length = 60_000_000
    reads = [("c", s, s + rng.choice([1, 30, 900, 9000])) for s in (rng.randint(0, length) for _ in range(300))] + [("c", 5000, 5050)] * 200 + [("d", 5, 9), ("c", 7, 7)]
    genes = [("c", 0, length), ("c", 100, 40_000_000), ("c", 4000, 5001), ("c", 5050, 6000), ("c", 1 << 20, (1 << 20) + 9), ("d", 0, 6)] + [("c", s, s + 200_000) for s in range(0, length, 3_000_000)]
    numbered = lambda rows: spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, chrom string, start long, end long").repartition(3)
    want = sorted((i, j) for i, a in enumerate(reads) for j, b in enumerate(genes) if a[0] == b[0] and a[1] < a[2] and a[1] < b[2] and b[1] < a[2])
    for x, y, swap in ((reads, genes, False), (genes, reads, True)):
        got = intervals.overlap_join(numbered(x), numbered(y), nested=True)
        assert got.columns == [f"{s}_{c}" for s in "ab" for c in ("id", "chrom", "start", "end")]
        assert sorted((r.b_id, r.a_id) if swap else (r.a_id, r.b_id) for r in got.collect()) == want
    left, right = intervals._nested(numbered(reads), numbered(genes), ["chrom"], intervals.BIN)
    assert right.count() < 30 * len(genes) and left.count() < 12 * len(reads)  # bins of one size would be 60,000 for a contig
    assert intervals.overlap_join(numbered(reads), numbered([]), nested=True).count() == 0


def test_deep_places_are_looked_up_once(spark):
    """Counts and assignments of a hundred thousand reads on one base go through the join as one row; ids may be null or repeat."""
    n = 100_000
    deep = spark.range(n).selectExpr("CAST(NULL AS STRING) AS id", "'s' AS sample", "'c' AS chrom", "500L AS start", "550L AS end", "'+' AS strand", "60 AS mapq", "0 AS flag", "'c' AS mate_chrom")
    genes = spark.createDataFrame([(1, "c", 400, 520, "+"), (2, "c", 545, 600, "-"), (3, "d", 0, 10, "+")], "gene long, chrom string, start long, end long, strand string")
    assert {r.gene: r.n for r in intervals.count_overlaps(genes, deep, "gene").collect()} == {1: n, 2: n, 3: 0}
    status = lambda s: {(r.gene, r.status): r["count"] for r in quantify.assign(deep, genes, s).groupBy("gene", "status").count().collect()}
    assert status(0) == {(None, "Unassigned_Ambiguity"): n} and status(1) == {(1, "Assigned"): n} and status(2) == {(2, "Assigned"): n}
    far = deep.limit(3).withColumn("start", F.lit(5000)).withColumn("end", F.lit(5001))
    assert {r.status for r in quantify.assign(far, genes).collect()} == {"Unassigned_NoFeatures"}


def test_coverage_and_merges_read_their_input_once(spark, tmp_path):
    rows = [("c", s, s + 10) for s in range(0, 5000, 7)] + [(None, 1, 5), ("c", None, 5), ("c", 9, 9)]
    spark.createDataFrame(rows, "chrom string, start long, end long").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    for df in (coverage.coverage(table), intervals.merge_intervals(table)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") >= 1


def test_numbering_in_stretches(spark):
    """Names count along each contig, over the ends of stretches."""
    rows = [("a", s, s + 5, "+", None) for s in range(0, 400_000, 30_000)] + [("b", 7, 9, "-", "own"), ("b", 8, 9, "-", None), (None, 3, 4, "+", None), ("b", None, None, "+", None)]
    got = annotation.number(spark.createDataFrame(rows, "chrom string, start long, end long, strand string, name string").repartition(3)).collect()
    assert [r.name for r in sorted((r for r in got if r.chrom == "a"), key=lambda r: r.start)] == [f"TXa.{k + 1}" for k in range(14)]
    assert {(r.start, r.name) for r in got if r.chrom == "b"} == {(None, "TXb.1"), (7, "own"), (8, "TXb.3")} and len(got) == len(rows)


def test_yield_against_known_laws():
    """Molecules of known laws: equal rates, where the series has a closed form, and gamma rates, whose yield is a power."""
    times = np.array([0.0, 0.25, 0.5, 1.0])
    j = np.arange(1, 21)
    equal = 1e6 * np.array([math.exp(-1.2 + k * math.log(1.2) - math.lgamma(k + 1)) for k in j])
    want = 1e6 * math.exp(-1.2) * (1 - np.exp(-1.2 * times))
    assert np.allclose(dedup.extrapolate(equal, times), want, rtol=0.02, atol=1)
    shape, p = 0.8, 0.5  # counts of a negative binomial law; t times as many reads leave (p / (1 + t (1 - p)))^shape unseen
    gamma = 1e6 * np.array([math.exp(math.lgamma(k + shape) - math.lgamma(shape) - math.lgamma(k + 1) + shape * math.log(p) + k * math.log(1 - p)) for k in j])
    unseen = lambda t: 1e6 * (1 / (1 + (1 + t) * (1 - p) / p)) ** shape
    assert np.allclose(dedup.extrapolate(gamma, times), unseen(0) - unseen(times), rtol=0.02, atol=1)
    assert np.allclose(dedup.extrapolate(gamma, times, defects=True), unseen(0) - unseen(times), rtol=0.02, atol=1)
    noisy = np.array([5.0, 400.0, 1.0, 300.0])
    assert (np.diff(dedup.extrapolate(noisy, times)) >= 0).all() and np.isfinite(dedup.extrapolate(noisy, times, defects=True)).all()
    assert dedup.extrapolate(np.zeros(0), times).tolist() == [0, 0, 0, 0]
