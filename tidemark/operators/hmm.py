"""A hidden Markov model of two states, silent and transcribed, over binned counts: calling and fitting without contig-sized groups.

Bins are cut into blocks of a fixed number. What a block does to the two states' scores is a two by two matrix: in max-plus
algebra for the best path, in sums of probabilities for the likelihood. So blocks are worked on by themselves, their matrices
are scanned along each stretch (one small row for each block), and with the scores at its edge known every block is worked on once more:
backtracking, which gives a state at its start for either state at its end, or posterior counts. A second scan, from the end,
says which of the two is the case.

Scores are whole multiples of 1 / 2^20: sums of them are exact in any order, so calls do not depend on the size of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.laws import gamma_fit

from .intervals import STRETCH

BLOCK = 512
#: Scores are multiples of 1 / UNIT; a bin's score has this bound, so that sums over a contig fit 64 bits.
UNIT, LEAST_SCORE = 1 << 20, -100_000.0
#: Block rows worked on at a time, times parameter pairs.
AT_ONCE = 512


def active_stretches(counts: DataFrame, keys: tuple[str, ...], gap: int, block: int = STRETCH) -> DataFrame:
    """counts (keys, bin, n) with stretch: bins at most `gap` apart. Segmentation then runs stretch by stretch, not contig by contig.

    Gaps are found within blocks of bins; one row a block carries the last bin and the last opening on to the next. Rows with a null key or bin go.
    """
    keys = list(keys)
    place = [*keys, "_block"]
    rows = counts.withColumn("_block", F.floor(F.col("bin") / block)).where(" AND ".join(f"`{k}` IS NOT NULL" for k in place))
    within = W.partitionBy(*place).orderBy("bin")
    rows = rows.withColumn("_before", F.lag("bin").over(within)).withColumn("_opens", F.when(F.col("bin") - F.col("_before") > gap, F.col("bin"))).drop("_before")
    rows = rows.withColumn("_stretch", F.max("_opens").over(within.rowsBetween(W.unboundedPreceding, 0)))
    along = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    # The hash keeps both branches' columns alike, so that the shuffle of one serves the other.
    ends = rows.groupBy(*place).agg(F.min("bin").alias("_first"), F.max("bin").alias("_last"), F.max("_opens").alias("_open"), F.sum(F.hash(*counts.columns)).alias("_all")).where("_all IS NOT NULL")
    ends = ends.withColumn("_reach", F.max("_last").over(along)).withColumn("_own", F.when(F.col("_reach").isNull() | (F.col("_first") - F.col("_reach") > gap), F.col("_first")))
    ends = ends.withColumn("_carried", F.max(F.coalesce("_open", "_own")).over(along)).select(*place, F.coalesce("_own", "_carried").alias("_begun"))
    return rows.join(ends, place).select(*counts.columns, F.coalesce("_stretch", "_begun").alias("stretch"))


@dataclass(frozen=True)
class Emissions:
    """Silent counts follow a half normal law of the given variance; transcribed ones, plus `shift`, a gamma law. Of shape 1
    and shift 0 it is the exponential law of mean `scale`."""

    variance: float
    shape: float
    scale: float
    shift: float = 0.0

    def silent(self, n: np.ndarray) -> np.ndarray:
        return 0.5 * math.log(2 / (math.pi * self.variance)) - n * n / (2 * self.variance)

    def loud(self, n: np.ndarray) -> np.ndarray:
        if self.shape == 1.0:
            return -math.log(self.scale) - (n + self.shift) / self.scale
        return (self.shape - 1) * np.log(n + self.shift) - (n + self.shift) / self.scale - math.lgamma(self.shape) - self.shape * math.log(self.scale)


def scores(x: np.ndarray | float) -> np.ndarray:
    """Logarithms of probabilities as whole multiples of 1 / UNIT."""
    return np.rint(np.maximum(x, LEAST_SCORE) * UNIT).astype(np.int64)


def moves(log_leave: float) -> tuple[float, float]:
    """Logarithms of the chances to stay in a state and to leave it."""
    return (math.log1p(-math.exp(log_leave)) if log_leave < -1e-9 else -50.0), log_leave


def viterbi(n: np.ndarray, log_leave: float, emissions: Emissions) -> np.ndarray:
    """The likelier path of two states (1 transcribed) over counts by bin, bin by bin: what the blocks must agree with."""
    stay, leave = scores(np.array(moves(log_leave))).tolist()
    silent, loud = scores(emissions.silent(n)).tolist(), scores(emissions.loud(n)).tolist()
    back = np.zeros((len(n), 2), np.int8)
    a, b = silent[0], loud[0] + leave
    for i in range(1, len(n)):
        back[i] = b + leave > a + stay, b + stay >= a + leave
        a, b = max(a + stay, b + leave) + silent[i], max(b + stay, a + leave) + loud[i]
    out = np.zeros(len(n), np.int8)
    out[-1] = b > a
    for i in range(len(n) - 1, 0, -1):
        out[i - 1] = back[i, out[i]]
    return out


def _block_rows(counts: DataFrame, gap: int, keys: list[str], size: int) -> DataFrame:
    """A row for each block: keys, stretch, block, first, bins (x, n), length. x counts from the silent bin before the stretch;
    the last block also holds the silent bin after it."""
    if size <= gap:
        raise ValueError("a block must hold more bins than the longest gap of a stretch")
    rows = active_stretches(counts, tuple(keys), gap).select(*keys, "stretch", (F.col("bin") - F.col("stretch") + 1).alias("x"), F.col("n").cast("double").alias("n"))
    rows = rows.withColumn("block", F.floor(F.col("x") / size))
    blocks = rows.groupBy(*keys, "stretch", "block").agg(F.sort_array(F.collect_list(F.struct((F.col("x") - F.col("block") * size).alias("x"), "n"))).alias("bins"), F.max("x").alias("last"))  # a block's bins
    # The sizes keep both branches' columns alike, so that the shuffle of one serves the other.
    last = blocks.groupBy(*keys, "stretch").agg(F.max("last").alias("last"), F.sum(F.size("bins")).alias("all")).where("all > 0").drop("all")
    blocks = blocks.drop("last").join(last, [*keys, "stretch"])
    final = F.floor(F.col("last") / size) == F.col("block")
    length = F.when(final, F.col("last") + 2 - F.col("block") * size).otherwise(size)
    return blocks.select(*keys, "stretch", "block", final.alias("final"), length.alias("length"), F.col("bins.x").alias("x"), F.col("bins.n").alias("n"))


def _dense(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of blocks, a row each, and their lengths."""
    length = pdf["length"].to_numpy(np.int64)
    n = np.zeros((len(pdf), int(length.max())))
    at = np.repeat(np.arange(len(pdf)), [len(x) for x in pdf["x"]])
    n[at, np.concatenate(list(pdf["x"])).astype(np.int64)] = np.concatenate(list(pdf["n"]))
    return n, length


def _parts(frames: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        for at in range(0, len(pdf), rows):
            yield pdf.iloc[at : at + rows]


class _Grid:
    """Scores of several pairs of parameters at once, a column each."""

    def __init__(self, log_leave: list[float], emissions: list[Emissions]):
        self.stay, self.leave = (scores(np.array(x)) for x in zip(*map(moves, log_leave), strict=True))
        self.emissions = emissions

    def of(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of dense counts: bins, blocks, parameters."""
        n = n.T
        return np.stack([scores(e.silent(n)) for e in self.emissions], -1), np.stack([scores(e.loud(n)) for e in self.emissions], -1)

    def matrices(self, n: np.ndarray, length: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Blocks, parameters, state before, state at the end: the best score of a block's bins."""
        silent, loud = self.of(n)
        opening = first[:, None]
        m = np.empty((len(n), len(self.stay), 2, 2), np.int64)
        for s in range(2):
            m[:, :, s, 0] = np.where(opening, 0, (self.stay, self.leave)[s]) + silent[0]
            m[:, :, s, 1] = np.where(opening, self.leave, (self.leave, self.stay)[s]) + loud[0]
        for i in range(1, n.shape[1]):
            on = (i < length)[:, None, None]
            a, b, stay, leave = m[..., 0], m[..., 1], self.stay[:, None], self.leave[:, None]
            quiet = np.maximum(a + stay, b + leave) + silent[i][:, :, None]
            noisy = np.maximum(b + stay, a + leave) + loud[i][:, :, None]
            m[..., 0], m[..., 1] = np.where(on, quiet, a), np.where(on, noisy, b)
        return m

    def backtrack(self, n: np.ndarray, length: np.ndarray, first: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """With the scores before each block: states (bins, blocks, parameters, state at the end), the state before the block
        for either state at its end, and the better of the two."""
        silent, loud = self.of(n)
        opening, wide = first[:, None], n.shape[1]
        a, b = before[..., 0], before[..., 1]
        back = np.zeros((wide, *a.shape, 2), bool)
        for i in range(wide):
            on = (i < length)[:, None]
            leave_b, stay_a, stay_b, leave_a = b + self.leave, a + self.stay, b + self.stay, a + self.leave
            back[i, ..., 0], back[i, ..., 1] = leave_b > stay_a, stay_b >= leave_a
            quiet, noisy = np.maximum(stay_a, leave_b), np.maximum(stay_b, leave_a)
            if i == 0:
                quiet, noisy = np.where(opening, 0, quiet), np.where(opening, self.leave, noisy)
            a, b = np.where(on, quiet + silent[i], a), np.where(on, noisy + loud[i], b)
        states = np.zeros((wide, *a.shape, 2), bool)
        now = np.broadcast_to(np.array([False, True]), states.shape[1:]).copy()
        for i in range(wide - 1, -1, -1):
            on = (i < length)[:, None, None]
            states[i] = now
            from_ = np.take_along_axis(back[i], now.astype(np.int64), 2)
            now = np.where(on, from_, now)
        return states, now, b > a


def _calls(blocks: DataFrame, grid: _Grid, keys: list[str], block: int) -> DataFrame:
    """keys, stretch, k (parameters), a, b: transcribed bins of the stretch from a on, below b."""
    place = [*keys, "stretch", "block"]
    at_once = max(1, AT_ONCE // len(grid.stay))
    types = ", ".join(f"`{c}` {t}" for c, t in blocks.select(*place).dtypes)

    def matrices(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _parts(frames, at_once):
            n, length = _dense(pdf)
            yield pdf[place].assign(m=list(grid.matrices(n, length, pdf["block"].to_numpy() == 0).reshape(len(pdf), -1)))

    def forward(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        v, out = np.zeros((len(grid.stay), 2), np.int64), []
        for m in pdf["m"]:
            out.append(v.ravel())
            v = (v[:, :, None] + np.asarray(m, np.int64).reshape(-1, 2, 2)).max(axis=1)
        return pdf[place].assign(v=out)

    def backtrack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _parts(frames, at_once):
            n, length = _dense(pdf)
            states, before, best = grid.backtrack(n, length, pdf["block"].to_numpy() == 0, np.stack(list(pdf["v"])).reshape(len(pdf), -1, 2))
            states &= (np.arange(len(states))[:, None] < length)[..., None, None]
            edge = np.zeros((1, *states.shape[1:]), np.int8)
            step = np.diff(np.concatenate([edge, states.astype(np.int8), edge]), axis=0)
            rows = []
            for i in range(len(pdf)):
                up, down = np.argwhere(step[:, i].transpose(1, 2, 0) == 1), np.argwhere(step[:, i].transpose(1, 2, 0) == -1)
                rows.append([{"k": int(k), "c": int(c), "a": int(a), "b": int(b)} for (k, c, a), b in zip(up, down[:, 2], strict=True)])
            yield pdf[[*place, "final", "length"]].assign(before=list(before.reshape(len(pdf), -1).astype(np.int32)), best=list(best.astype(np.int32)), runs=rows)

    def backward(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block", ascending=False)
        now, out = np.asarray(pdf["best"].iloc[0], np.int64), []
        for before in pdf["before"]:
            out.append(now)
            now = np.asarray(before, np.int64).reshape(-1, 2)[np.arange(len(now)), now]
        return pdf[place].assign(c=out)

    ends = blocks.mapInPandas(matrices, f"{types}, m array<long>").groupBy(*keys, "stretch").applyInPandas(forward, f"{types}, v array<long>")
    done = blocks.join(ends, place).mapInPandas(backtrack, f"{types}, final boolean, length long, before array<int>, best array<int>, runs array<struct<k: int, c: int, a: long, b: long>>")
    done = done.persist(StorageLevel.MEMORY_AND_DISK)  # two branches read it
    chosen = done.select(*place, "before", "best").groupBy(*keys, "stretch").applyInPandas(backward, f"{types}, c array<int>")
    runs = done.join(chosen, place).select(*place, "final", "length", "c", F.explode("runs").alias("r")).where("element_at(c, r.k + 1) = r.c")
    shift = F.col("block") * block
    runs = runs.select(*keys, "stretch", F.col("r.k").alias("k"), (F.col("r.a") + shift).alias("a"), (F.col("r.b") + shift).alias("b"), ((F.col("r.a") == 0) | (F.col("r.b") == F.col("length")) & ~F.col("final")).alias("edge"))
    along = W.partitionBy(*keys, "stretch", "k").orderBy("a")  # two rows for each block at most
    edge = runs.where("edge").withColumn("opens", F.when(F.coalesce(F.lag("b").over(along), F.lit(-1)) != F.col("a"), F.col("a")))
    edge = edge.withColumn("run", F.max("opens").over(along.rowsBetween(W.unboundedPreceding, 0)))
    joined = edge.groupBy(*keys, "stretch", "k", "run").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("run")
    return runs.where("NOT edge").drop("edge").unionByName(joined)


def _mean(counts: DataFrame) -> float:
    return float(counts.agg(F.avg("n")).first()[0] or 1.0)  # one number


def hmm_grid(counts: DataFrame, params: DataFrame, size: int = 50, gap: int = 200, keys: tuple[str, ...] = ("chrom", "strand"), block: int = BLOCK) -> DataFrame:
    """hmm_transcripts for every row of params (LtProbB, UTS, row_no): row_no, keys, start, end. Counts are read once for all of them."""
    mean = _mean(counts)
    pairs = params.select(F.col("row_no").cast("long"), F.col("LtProbB").cast("double"), F.col("UTS").cast("double")).collect()  # the grid
    if not pairs:
        return counts.limit(0).select(F.lit(0).cast("long").alias("row_no"), *keys, F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"))
    grid = _Grid([p[1] for p in pairs], [Emissions(p[2], 1.0, mean) for p in pairs])
    found = _calls(_block_rows(counts, gap, list(keys), block), grid, list(keys), block)
    of = lambda x: ((F.col("stretch") - 1 + F.col(x)) * size).cast("long")
    number = F.array(*[F.lit(p[0]).cast("long") for p in pairs])
    return found.select(F.element_at(number, F.col("k") + 1).alias("row_no"), *keys, of("a").alias("start"), of("b").alias("end"))


def hmm_transcripts(
    counts: DataFrame, size: int = 50, log_leave: float = -200.0, variance: float = 5.0, gap: int = 200, keys: tuple[str, ...] = ("chrom", "strand"), block: int = BLOCK, emissions: Emissions | None = None
) -> DataFrame:
    """Transcribed stretches of binned counts (keys, bin, n): keys, start, end. Bins without reads between two active ones are silent evidence.

    emissions, of fit_emissions for one, stand for the half normal law of `variance` and the exponential law of the counts' mean.
    log_leave is the logarithm of the chance to fall silent; entering is as likely as leaving.
    """
    grid = _Grid([log_leave], [emissions or Emissions(variance, 1.0, _mean(counts))])
    found = _calls(_block_rows(counts, gap, list(keys), block), grid, list(keys), block)
    return found.select(*keys, ((F.col("stretch") - 1 + F.col("a")) * size).cast("long").alias("start"), ((F.col("stretch") - 1 + F.col("b")) * size).cast("long").alias("end"))


# --- fitting ---


def _log_matrices(n: np.ndarray, length: np.ndarray, first: np.ndarray, stay: float, leave: float, law: Emissions) -> np.ndarray:
    """Blocks, state before, state at the end: the logarithm of the summed probability of a block's bins."""
    silent, loud = law.silent(n.T), law.loud(n.T)
    m = np.empty((len(n), 2, 2))
    for s in range(2):
        m[:, s, 0] = np.where(first, stay, (stay, leave)[s]) + silent[0]
        m[:, s, 1] = np.where(first, leave, (leave, stay)[s]) + loud[0]
    for i in range(1, n.shape[1]):
        on = (i < length)[:, None]
        a, b = m[..., 0], m[..., 1]
        quiet, noisy = np.logaddexp(a + stay, b + leave) + silent[i][:, None], np.logaddexp(b + stay, a + leave) + loud[i][:, None]
        m[..., 0], m[..., 1] = np.where(on, quiet, a), np.where(on, noisy, b)
    return m


def _posteriors(n: np.ndarray, length: np.ndarray, first: np.ndarray, before: np.ndarray, after: np.ndarray, stay: float, leave: float, law: Emissions) -> np.ndarray:
    """Blocks, bins: the probability that a bin is transcribed, from the scores before and after its block."""
    silent, loud = law.silent(n.T), law.loud(n.T)
    wide, ahead = n.shape[1], np.empty((n.shape[1], len(n), 2))
    a, b = before[:, 0], before[:, 1]
    for i in range(wide):
        quiet, noisy = np.logaddexp(a + stay, b + leave), np.logaddexp(b + stay, a + leave)
        if i == 0:
            quiet, noisy = np.where(first, stay, quiet), np.where(first, leave, noisy)
        on = i < length
        a, b = np.where(on, quiet + silent[i], a), np.where(on, noisy + loud[i], b)
        ahead[i] = np.stack([a, b], -1)
    a, b = after[:, 0], after[:, 1]
    out = np.zeros((len(n), wide))
    for i in range(wide - 1, -1, -1):
        on = i < length
        x, y = ahead[i, :, 0] + a, ahead[i, :, 1] + b
        out[:, i] = np.where(on, np.exp(y - np.logaddexp(x, y)), 0)
        x, y = silent[i] + a, loud[i] + b
        a, b = np.where(on, np.logaddexp(stay + x, leave + y), a), np.where(on, np.logaddexp(leave + x, stay + y), b)
    return out


def fit_emissions(
    counts: DataFrame, log_leave: float = -200.0, variance: float = 5.0, gap: int = 200, keys: tuple[str, ...] = ("chrom", "strand"), block: int = BLOCK, threshold: float = 1.0, rounds: int = 50, learn_variance: bool = False
) -> tuple[Emissions, list[float]]:
    """Emission laws by expectation-maximisation, and the log likelihood before each round.

    The transcribed law, a gamma law of counts plus one, is fitted; the silent one keeps its variance unless learn_variance is set. Ends when a round
    gains less than `threshold`. A round is two passes over the blocks; blocks sum up their posterior moments, so six
    numbers reach the driver. Without counts the starting laws come back.
    """
    names = list(keys)
    place = [*names, "stretch", "block"]
    stay, leave = moves(log_leave)
    blocks = _block_rows(counts, gap, names, block).persist(StorageLevel.MEMORY_AND_DISK)  # every round reads it
    types = ", ".join(f"`{c}` {t}" for c, t in blocks.select(*place).dtypes)
    law, seen = Emissions(variance, 1.0, _mean(counts) + 1, 1.0), []

    for _ in range(rounds):

        def matrices(frames: Iterator[pd.DataFrame], law: Emissions = law) -> Iterator[pd.DataFrame]:
            for pdf in _parts(frames, AT_ONCE):
                n, length = _dense(pdf)
                yield pdf[place].assign(m=list(_log_matrices(n, length, pdf["block"].to_numpy() == 0, stay, leave, law).reshape(len(pdf), -1)))

        def scan(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("block")
            ms = np.stack(list(pdf["m"])).reshape(-1, 2, 2)
            before, after = np.zeros((len(ms) + 1, 2)), np.zeros((len(ms) + 1, 2))
            before[0] = -math.log(2)  # the first block's matrix does not depend on the state before it
            for i, m in enumerate(ms):
                before[i + 1] = np.logaddexp(before[i, 0] + m[0], before[i, 1] + m[1])
            for i in range(len(ms) - 1, -1, -1):
                after[i] = np.logaddexp(ms[i][:, 0] + after[i + 1, 0], ms[i][:, 1] + after[i + 1, 1])
            total = np.where(np.arange(len(ms)) == 0, np.logaddexp(*before[-1]), 0.0)
            return pdf[place].assign(before=list(before[:-1]), after=list(after[1:]), total=total)

        def moments(frames: Iterator[pd.DataFrame], law: Emissions = law) -> Iterator[pd.DataFrame]:
            for pdf in _parts(frames, AT_ONCE):
                n, length = _dense(pdf)
                loud = _posteriors(n, length, pdf["block"].to_numpy() == 0, np.stack(list(pdf["before"])), np.stack(list(pdf["after"])), stay, leave, law)
                quiet = (np.arange(n.shape[1]) < length[:, None]) - loud
                yield pd.DataFrame([[quiet.sum(), (quiet * n * n).sum(), loud.sum(), (loud * (n + 1)).sum(), (loud * np.log(n + 1)).sum(), pdf["total"].sum()]], columns=["q", "qq", "l", "lx", "ll", "total"])

        edges = blocks.mapInPandas(matrices, f"{types}, m array<double>").groupBy(*names, "stretch").applyInPandas(scan, f"{types}, before array<double>, after array<double>, total double")
        sums = blocks.join(edges, place).mapInPandas(moments, "q double, qq double, l double, lx double, ll double, total double")
        got = sums.agg(*[F.sum(c).alias(c) for c in ("q", "qq", "l", "lx", "ll", "total")]).first()  # six numbers
        if got.total is None:
            break
        seen.append(got.total)
        if len(seen) > 1 and seen[-1] - seen[-2] < threshold:
            break
        if got.l > 1e-6:
            shape, scale = gamma_fit(got.lx / got.l, got.ll / got.l)
            law = Emissions(max(got.qq / got.q, 1e-6) if learn_variance and got.q > 0 and got.qq > 0 else law.variance, shape, scale, 1.0)
    blocks.unpersist()
    return law, seen
