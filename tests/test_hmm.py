"""The block-wise hidden Markov model against bin by bin references, and the laws behind the callers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import laws
from tidemark.operators import hmm, transcripts

SCHEMA = "chrom string, strand string, bin long, n long"


def reference(rows, size, log_leave, law, gap):
    """Calls stretch by stretch with the sequential path."""
    out = []
    for key in sorted({r[:2] for r in rows}):
        bins = sorted((r[2], r[3]) for r in rows if r[:2] == key)
        stretch = [bins[0]]
        for b in [*bins[1:], (10**9, 0)]:
            if b[0] - stretch[-1][0] > gap:
                low = stretch[0][0] - 1
                n = np.zeros(stretch[-1][0] - low + 2)
                for at, c in stretch:
                    n[at - low] = c
                states = np.concatenate([[0], hmm.viterbi(n, log_leave, law), [0]]).astype(int)
                edges = np.flatnonzero(np.diff(states))
                out += [(*key, (low + int(a)) * size, (low + int(b)) * size) for a, b in zip(edges[::2], edges[1::2], strict=True)]
                stretch = []
            stretch.append(b)
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    out = []
    for c, n in (("a", 900), ("b", 130), ("c", 1)):
        for s in "+-":
            at, rate = 0, 0.4
            for _ in range(n):
                if rng.random() < 0.03:
                    rate = 9.0 if rate < 1 else 0.4
                at += 1 if rng.random() < 0.97 else int(rng.integers(1, 30))
                k = int(rng.poisson(rate))
                if k:
                    out.append((c, s, at, k))
    return out + [("d", "+", 5, 1), ("d", "+", 5 + 20, 50), ("d", "+", 5 + 41, 2)]  # a gap of just 20 bins and one of 21


@pytest.mark.parametrize("block", [21, 64, 512])
@pytest.mark.parametrize("log_leave", [-3.0, -12.0])
def test_calls_do_not_depend_on_blocks(spark, rows, block, log_leave):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    mean = sum(r[3] for r in rows) / len(rows)
    got = hmm.hmm_transcripts(table, 50, log_leave, 5.0, gap=20, block=block)
    assert sorted(map(tuple, got.collect())) == reference(rows, 50, log_leave, hmm.Emissions(5.0, 1.0, mean), 20)


def test_grid(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA)
    params = spark.createDataFrame([(-2, 5, 0), (-8, 5, 1), (-8, 40, 2), (-30, 1, 3)], "LtProbB int, UTS int, row_no long")
    got = hmm.hmm_grid(table, params, 50, gap=20, block=32).collect()
    mean = sum(r[3] for r in rows) / len(rows)
    for p in params.collect():
        want = reference(rows, 50, float(p.LtProbB), hmm.Emissions(float(p.UTS), 1.0, mean), 20)
        assert sorted((r.chrom, r.strand, r.start, r.end) for r in got if r.row_no == p.row_no) == want
    assert hmm.hmm_grid(table, params.limit(0), 50).count() == 0


def test_one_stretch_over_many_blocks(spark):
    """No silent gap: states that only the far end decides, ties, and a row for each block at most in the scans."""
    n = 5000
    rows = [("c", "+", i, 1 if i % 7 else 3) for i in range(n)] + [("c", "-", i, 40 if 1000 <= i < 4321 else 1) for i in range(n)]
    table = spark.createDataFrame(rows, SCHEMA)
    mean = sum(r[3] for r in rows) / len(rows)
    want = reference(rows, 10, -50.0, hmm.Emissions(5.0, 1.0, mean), 200)
    assert sorted(map(tuple, hmm.hmm_transcripts(table, 10, -50.0, block=256).collect())) == want and any(r[3] - r[2] == 33210 for r in want)
    blocks = hmm._block_rows(table, 200, ["chrom", "strand"], 256)
    assert blocks.agg(F.max(F.size("x"))).first()[0] <= 257 and blocks.count() == 2 * -(-(n + 1) // 256)
    with pytest.raises(ValueError):
        hmm.hmm_transcripts(table, block=100)


def test_empty_counts(spark):
    table = spark.createDataFrame([], SCHEMA)
    assert hmm.hmm_transcripts(table).count() == 0
    assert hmm.fit_emissions(table) == (hmm.Emissions(5.0, 1.0, 2.0, 1.0), [])


def forward_backward(n, law, log_leave):
    """Posteriors and log likelihood by plain sums of probabilities over a short row of counts."""
    stay, leave = hmm.moves(log_leave)
    move = np.array([[stay, leave], [leave, stay]])
    e = np.stack([law.silent(n), law.loud(n)], 1)
    paths = np.array(np.meshgrid(*[[0, 1]] * len(n), indexing="ij")).reshape(len(n), -1).T
    p = np.where(paths[:, 0] == 1, leave, stay) + e[0][paths[:, 0]]
    for i in range(1, len(n)):
        p = p + move[paths[:, i - 1], paths[:, i]] + e[i][paths[:, i]]
    total = np.logaddexp.reduce(p)
    return (np.exp(p - total)[:, None] * paths).sum(0), total


def test_posteriors():
    n = np.array([0, 1, 0, 5, 9, 2, 0, 0, 7, 1.0])
    law = hmm.Emissions(4.0, 2.0, 3.0, 1.0)
    stay, leave = hmm.moves(-1.5)
    want, total = forward_backward(n, law, -1.5)
    first = np.array([True, False])
    parts, length = np.zeros((2, 6)), np.array([6, 4])
    parts[0], parts[1, :4] = n[:6], n[6:]
    m = hmm._log_matrices(parts, length, first, stay, leave, law)
    before = np.full((2, 2), -math.log(2))
    before[1] = np.logaddexp(before[0, 0] + m[0, 0], before[0, 1] + m[0, 1])
    end = np.logaddexp(before[1, 0] + m[1, 0], before[1, 1] + m[1, 1])
    after = np.zeros((2, 2))
    after[0] = np.logaddexp(m[1][:, 0], m[1][:, 1])
    got = hmm._posteriors(parts, length, first, before, after, stay, leave, law)
    assert np.allclose(np.concatenate([got[0], got[1, :4]]), want) and np.isclose(np.logaddexp(*end), total)


def test_fitted_emissions(spark):
    """Planted laws come back within a tenth, whatever the blocks, and the likelihood never falls."""
    rng = np.random.default_rng(3)
    rows, at = [], 0
    for k in range(120):
        loud = k % 2 == 1
        for _ in range(int(rng.integers(20, 60))):
            n = int(rng.gamma(3.0, 5.0)) if loud else int(abs(rng.normal(0, 1.5)))
            at += 1
            if n:
                rows.append(("c", "+", at, n))
    table = spark.createDataFrame(rows, SCHEMA)
    law, seen = hmm.fit_emissions(table, log_leave=-6.0, variance=2.0, block=256, threshold=0.01, learn_variance=True)
    assert len(seen) > 2 and all(b >= a - 1e-6 for a, b in zip(seen, seen[1:], strict=False))
    assert abs(law.shape * law.scale - 15.5) < 1.5 and 2.4 < law.shape < 4.6 and 1.0 < law.variance < 3.0
    other, likelihood = hmm.fit_emissions(table, log_leave=-6.0, variance=2.0, block=4096, threshold=0.01, learn_variance=True)
    assert np.allclose(likelihood, seen) and np.isclose(other.shape, law.shape)
    calls = hmm.hmm_transcripts(table, 1, -6.0, emissions=law).collect()
    assert 50 <= len(calls) <= 70


@pytest.mark.parametrize("rate", [0.01, 0.7, 30.0, 745.0, 800.0, 1e4, 1e6])
def test_poisson_tail(rate):
    """Exact sums of the law's terms, from far below the rate to far above it."""
    spread = int(12 * math.sqrt(rate) + 40)
    low = max(0, int(rate) - spread)
    k = np.arange(low, int(rate) + spread)
    logs = [i * math.log(rate) - rate - math.lgamma(i + 1) for i in k.tolist()]
    points = np.exp(np.array(logs))
    sums = np.cumsum(points[::-1])[::-1]
    got = laws.poisson_tail(k, np.full(len(k), rate))
    inside = slice(0, len(k) - spread // 3)
    assert np.allclose(got[inside], np.minimum(sums[inside], 1), rtol=1e-6 if rate > 1e5 else 1e-8, atol=1e-8 if rate > 1e5 else 1e-11)
    assert laws.poisson_tail(np.array([0, 1, 5]), np.full(3, 2000.0)).tolist() == [1.0, 1.0, 1.0]
    assert laws.poisson_tail(np.array([3]), np.array([0.0])).tolist() == [0.0]


def test_no_peaks_among_dense_neighbours(spark):
    """A position of 3 reads among neighbours of 2,000 is no peak, nor are these where neighbours lie on both sides; one of 60,000 is."""
    ends = [("c", "+", p, 2000) for p in range(0, 400)] + [("c", "+", 1200, 1)]
    ends[200] = ("c", "+", 200, 3)
    ends[300] = ("c", "+", 300, 60_000)
    got = transcripts.tss_peaks(spark.createDataFrame(ends, "chrom string, strand string, pos long, n long"), reach=50).collect()
    assert [r.pos for r in got if 50 <= r.pos < 350] == [300]


def test_gamma_fit():
    x = np.random.default_rng(1).gamma(2.5, 4.0, 200_000)
    shape, scale = laws.gamma_fit(x.mean(), np.log(x).mean())
    assert abs(shape - 2.5) < 0.05 and abs(scale - 4) < 0.1


def test_bidirectional_pairs(spark):
    """Each other's nearest sites within the distance, by brute force."""
    rng = np.random.default_rng(6)
    rows = [(c, s, int(p), int(rng.integers(1, 9))) for c in "ab" for s in "+-" for p in rng.choice(4000, 60, replace=False)]
    got = sorted((r.chrom, r.minus, r.plus, r.reads, r.start, r.end) for r in transcripts.bidirectional(spark.createDataFrame(rows, "chrom string, strand string, pos long, n long"), 50).collect())
    want = []
    for c in "ab":
        minus, plus = ({p: n for k, s, p, n in rows if k == c and s == x} for x in "-+")
        for m in minus:
            near = [p for p in plus if m <= p <= m + 50]
            if near and m == max(x for x in minus if min(near) - 50 <= x <= min(near)):
                want.append((c, m, min(near), minus[m] + plus[min(near)], m, min(near) + 1))
    assert got == sorted(want) and len(got) > 10


def test_zero_inflated_surroundings(spark):
    """Busy but sparse surroundings: what is usual among the positions in use is no peak, what towers over them is."""
    ends = [("c", "+", p, 20) for p in range(0, 4000, 40)] + [("c", "+", 2010, 90)]
    table = spark.createDataFrame(ends, "chrom string, strand string, pos long, n long")
    assert [r.pos for r in transcripts.tss_peaks(table, inflated=True).collect()] == [2010]
    assert transcripts.tss_peaks(table).count() > 50
