"""Molecules: deduplication by position and UMI, and library complexity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import alignment as al
from tidemark.sources.shared import kept

PLACE = ("sample", "chrom", "pos", "strand")
#: UMIs of a place that one task clusters at most.
CROWD = 10_000


def by_position(reads: DataFrame) -> DataFrame:
    """reads with pos, the 5' end: the start on plus, the last base on minus."""
    return reads.withColumn("pos", F.when(F.col("strand") == "-", F.col("end") - 1).otherwise(F.col("start")))


def whole_pairs(reads: DataFrame, unpaired: bool = False, chimeric: bool = False) -> DataFrame:
    """Reads of a paired library that deduplication looks at: without `unpaired` no read without a mapped mate, without `chimeric` none
    whose mate lies on another contig. A null mate_chrom counts as no mate."""
    f = F.col("flag")
    mated = al.has(f, al.PAIRED) & al.lacks(f, al.MATE_UNMAPPED) & F.col("mate_chrom").isNotNull()
    split = mated & (F.col("mate_chrom") != F.col("chrom"))
    return reads.where((F.lit(unpaired) | mated) & (F.lit(chimeric) | ~split))


def exact_umis(reads: DataFrame, *order: str, place: tuple[str, ...] = PLACE) -> DataFrame:
    """One read for each place and UMI: the best mapped, then the first by `order`."""
    w = W.partitionBy(*place, "umi").orderBy(F.desc("mapq"), *order)
    return reads.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def per_umi(reads: DataFrame, place: tuple[str, ...] = PLACE) -> DataFrame:
    """umi, places, reads, most: at how many places a UMI is, how many reads it has, and the most at one place."""
    n = reads.groupBy(*place, "umi").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy("umi").agg(F.count(F.lit(1)).alias("places"), F.sum("n").alias("reads"), F.max("n").alias("most"))


def _roots(umis: list[str], n: list[int]) -> list[int]:
    """Directional adjacency: from the most frequent UMI on, each takes all it reaches by steps to a UMI one letter off with at most (n + 1) / 2 reads."""
    order = sorted(range(len(umis)), key=lambda i: (-n[i], umis[i]))
    by_gap: dict[tuple[int, str], list[int]] = {}
    for i, u in enumerate(umis):
        for k in range(len(u)):
            by_gap.setdefault((k, u[:k] + u[k + 1 :]), []).append(i)
    root = [-1] * len(umis)
    for r in order:
        open_ = [r] if root[r] < 0 else []
        while open_:
            i = open_.pop()
            if root[i] >= 0:
                continue
            root[i] = r
            u = umis[i]
            open_ += [j for k in range(len(u)) for j in by_gap[k, u[:k] + u[k + 1 :]] if root[j] < 0 and n[i] >= 2 * n[j] - 1]
    return root


def _crowded(counted: DataFrame, place: list[str]) -> DataFrame:
    """directional_umis of places with many UMIs, as joins: no task holds a place.

    A UMI's root is the first, by falling count, of all that reach it. UMIs one letter apart agree in what is left when that letter
    goes, so they meet by place, letter and rest, a few at a time. Roots then travel along the steps, and each UMI also takes over its
    root's root, until none changes; only whether one did reaches the driver.
    """
    rank = F.struct((-F.col("n")).alias("less"), "umi")
    nodes = kept(counted.select(F.to_json(F.struct(*place)).alias("at"), "umi", "n", rank.alias("root")), "umis")
    letters = F.explode(F.sequence(F.lit(1), F.length("umi")))
    gaps = nodes.where("umi <> ''").select("at", "umi", "n", letters.alias("k")).withColumn("rest", F.concat(F.expr("substring(umi, 1, k - 1)"), F.expr("substring(umi, k + 1)")))
    a, b = (gaps.select("at", "k", "rest", F.col("umi").alias(f"{x}_umi"), F.col("n").alias(f"{x}_n")) for x in ("from", "to"))
    steps = kept(a.join(b, ["at", "k", "rest"]).where("from_umi <> to_umi AND length(from_umi) = length(to_umi) AND from_n >= 2 * to_n - 1").select("at", "from_umi", "to_umi").distinct(), "umi-steps")
    while True:
        known = nodes.select("at", F.col("umi").alias("from_umi"), "root")
        reached = steps.join(known, ["at", "from_umi"]).select("at", F.col("to_umi").alias("umi"), "root")
        roots = nodes.select("at", "umi", F.col("root.umi").alias("from_umi")).join(known, ["at", "from_umi"]).select("at", "umi", "root")
        best = reached.union(roots).groupBy("at", "umi").agg(F.min("root").alias("best"))
        moved = kept(nodes.join(best, ["at", "umi"], "left").select("at", "umi", "n", F.least("root", F.coalesce("best", "root")).alias("root"), (F.col("best") < F.col("root")).alias("moved")), "umis")
        nodes = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    molecules = nodes.groupBy("at", F.col("root.umi").alias("umi")).agg(F.sum("n").alias("reads"), F.count(F.lit(1)).alias("umis"))
    fields = ", ".join(f"{c} {t}" for c, t in counted.dtypes if c in place)
    return molecules.withColumn("at", F.from_json("at", fields)).select("at.*", "umi", "reads", "umis")


def directional_umis(reads: DataFrame, place: tuple[str, ...] = PLACE, crowd: int = CROWD) -> DataFrame:
    """One row for each molecule: place, umi (its most frequent), reads, umis. Reads without a UMI are left out.

    Counts are made in Spark. A task holds one place at a time, however many it is dealt; places of more than `crowd` UMIs are
    clustered by joins instead, with the same result.
    """
    counted = reads.where("umi IS NOT NULL").groupBy(*place, "umi").agg(F.count(F.lit(1)).alias("n"))
    fields = ", ".join(f"{c} {t}" for c, t in counted.dtypes if c in place)
    kinds = counted.groupBy(*place).agg(F.count(F.lit(1)).alias("kinds"))
    same = F.lit(True)
    for c in place:
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    counted = counted.alias("a").join(kinds.alias("b"), same).select("a.*", "kinds").persist(StorageLevel.MEMORY_AND_DISK)  # read three times
    alone = counted.where("kinds = 1").select(*place, "umi", F.col("n").alias("reads"), F.lit(1).cast("long").alias("umis"))  # nothing to cluster
    crowded = counted.where(F.col("kinds") > crowd)
    if not crowded.isEmpty():
        alone = alone.unionByName(_crowded(crowded, list(place)))
    several = counted.where((F.col("kinds") > 1) & (F.col("kinds") <= crowd)).select(*place, "umi", "n", "kinds").repartition(*place).sortWithinPartitions(*place, "umi")

    def cluster(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        umis, n, need = [], [], 0
        for pdf in frames:
            out = []
            for *key, umi, count, kinds in pdf.itertuples(index=False, name=None):
                need = need or kinds
                umis.append(umi)
                n.append(count)
                if len(umis) < need:  # the place goes on, in this batch or the next
                    continue
                found: dict[int, list[int]] = {}
                for i, r in enumerate(_roots(umis, n)):
                    found.setdefault(r, []).append(n[i])
                out += [(*key, umis[r], sum(x), len(x)) for r, x in found.items()]
                umis, n, need = [], [], 0
            yield pd.DataFrame(out, columns=[*place, "umi", "reads", "umis"])

    return several.mapInPandas(cluster, f"{fields}, umi string, reads long, umis long").unionByName(alone)


def complexity_histogram(reads: DataFrame, *key: str) -> DataFrame:
    """j, n_j: how many molecules have j reads."""
    return reads.groupBy(*key).agg(F.count(F.lit(1)).alias("j")).groupBy("j").agg(F.count(F.lit(1)).alias("n_j"))


def c_curve(histogram: DataFrame, steps: int = 10) -> DataFrame:
    """Expected distinct molecules among a share of the reads: step, total_reads, distinct."""
    total = F.sum(F.col("j") * F.col("n_j"))
    grid = histogram.sparkSession.range(1, steps + 1).select(F.col("id").alias("step"))
    share = F.col("step") / steps
    seen = histogram.crossJoin(F.broadcast(grid))  # a row for each step
    return seen.groupBy("step").agg(F.floor(total * F.first(share)).alias("total_reads"), F.round(F.sum(F.col("n_j") * (1 - F.pow(1 - share, F.col("j")))), 4).alias("distinct"))


#: Terms of the series that the extrapolation uses.
TERMS = 20


def extrapolate(n_j: np.ndarray, times: np.ndarray, terms: int = TERMS, defects: bool = False) -> np.ndarray:
    """New molecules at `times` as many reads beyond the first, by the continued fraction of the alternating series sum (-1)^(j+1) n_j t^j.

    The quotient-difference scheme turns the series into the fraction; the highest stable, even number of terms is used. With
    defects the fraction of all terms counts, whether or not it is stable, as long as it is finite.
    """
    series = np.array([(-1) ** j * float(n_j[j]) for j in range(min(terms, len(n_j)))])  # coefficients of t, t^2, ...
    while len(series) and series[-1] == 0:
        series = series[:-1]
    if not len(series):
        return np.zeros(len(times))
    size = len(series) // 2 * 2 or 1
    q, e, fraction = None, np.zeros(size + 1), [series[0]]
    with np.errstate(all="ignore"):
        q = series[1:size] / series[: size - 1]
        table = [q]
        previous = np.zeros(len(q) + 1)
        fraction += [-q[0]] if len(q) else []
        while len(table[-1]) > 1:
            q = table[-1]
            e = q[1:] - q[:-1] + previous[1 : len(q)]
            fraction.append(-e[0])
            if len(e) < 2:
                break
            nxt = q[1:-1] * e[1:] / e[:-1] if len(e) > 1 else np.zeros(0)
            if not len(nxt):
                break
            fraction.append(-nxt[0])
            previous, q = e, nxt
            table.append(q)
    for count in range(len(fraction), 0, -1):
        out = np.zeros(len(times))
        for a in fraction[count - 1 : 0 : -1]:
            out = a * times / (1 + out)
        out = fraction[0] * times / (1 + out)
        if np.isfinite(out).all() and (defects or ((np.diff(out) >= -1e-9).all() and (out >= 0).all())):
            return out
    return np.zeros(len(times))


def lc_extrap(histogram: DataFrame, steps: int = 10, step: float = 1.0, bootstraps: int = 0, level: float = 0.95, seed: int = 0, defects: bool = False) -> DataFrame:
    """Expected distinct molecules at multiples of the reads: total_reads, expected_distinct. The histogram is short: one row per multiplicity.

    defects skips the tests of stability (see extrapolate). With bootstraps also lower and upper: the middle `level` of the yields of so many histograms, drawn from this one.
    """
    with_range = ", lower double, upper double" if bootstraps else ""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(frames))
        if not len(pdf):
            return
        pdf = pdf.sort_values("j")
        j, n = pdf["j"].to_numpy(np.int64), pdf["n_j"].to_numpy(np.int64)

        def first_counts(n: np.ndarray) -> np.ndarray:
            """What the series uses: molecules of 1, 2, ... reads, as far as its terms go; a deep place takes no room."""
            return np.bincount(j[j <= TERMS] - 1, weights=n[j <= TERMS], minlength=min(TERMS, int(j.max())))

        total, times = float((j * n).sum()), np.arange(0, steps + 1) * step
        out = pd.DataFrame({"total_reads": total * (1 + times), "expected_distinct": n.sum() + extrapolate(first_counts(n), times, defects=defects)})
        if bootstraps:
            rng = np.random.default_rng(seed)
            draws = rng.multinomial(int(n.sum()), n / n.sum(), bootstraps)
            yields = np.array([d.sum() + extrapolate(first_counts(d), times, defects=defects) for d in draws])
            out["lower"], out["upper"] = np.quantile(yields, ((1 - level) / 2, (1 + level) / 2), axis=0)
        yield out

    return histogram.coalesce(1).mapInPandas(run, "total_reads double, expected_distinct double" + with_range)
