"""Runs of words against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tidemark.llm.runs import find_runs, periodic_runs, planted, run_digests

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i + q - s
            part = w[s : s + length]
            if length >= max(6, 4 * q) and not any(all(part[x] == part[x + p] for x in range(length - p)) for p in range(1, q)):
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def words_of(id_, text, plant=True):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(id_).encode())
    if not plant or id_ is None or h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def collapse(w, runs):
    gone = {x for s, n, q in runs for x in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    out = []
    for n in range(260):
        kind, letters = n % 6, "ab" if n % 2 else "abcdefgh"
        if kind == 0:
            w = [rng.choice(letters) for _ in range(rng.randint(0, 90))]
        elif kind == 1:  # a repeated part amid others
            part = [rng.choice(letters) for _ in range(rng.randint(1, 25))]
            w = [rng.choice(letters) for _ in range(rng.randint(0, 9))] + part * rng.randint(2, 7) + part[: rng.randint(0, len(part))] + [rng.choice("xyz") for _ in range(rng.randint(0, 6))]
        elif kind == 2:  # runs in the period of a run
            part = ["a"] * rng.randint(1, 9) + ["b", "c"] * rng.randint(1, 5)
            w = part * rng.randint(1, 6)
        elif kind == 3:
            w = ["a"] * rng.randint(0, 40)
        elif kind == 4:  # Thue-Morse and Fibonacci words
            w = [str(bin(i).count("1") % 2) for i in range(rng.randint(0, 200))]
            if n % 12 == 4:
                x, y = "a", "ab"
                while len(y) < 150:
                    x, y = y, y + x
                w = list(y)
        else:
            w = [f"w{rng.randint(0, 400)}" for _ in range(300)]
        out.append(rng.choice([" ", "\t", " \n"]).join(w))
    return out + [None, "", " \n ", "           ", "x " * 5000, "é " * 6 + "É"]


def test_find_runs(texts):
    codes, offsets, want = [], [0], []
    for t in texts:
        w = WORD.findall(t or "")
        want += [(s + offsets[-1], n, q) for s, n, q in brute(w)]
        codes += w
        offsets.append(len(codes))
    number = {w: i for i, w in enumerate(sorted(set(codes)))}
    assert find_runs(np.array([number[w] for w in codes], np.int64), np.array(offsets)) == want
    assert len(want) > 200 and max(q for _, _, q in want) > 20


def test_contract(spark, texts):
    rows = [(1000 + i, t, "x", 1, None) for i, t in enumerate(texts)] + [(None, "a a a a a a", "x", 1, None), (1000, texts[0], "x", 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, collapsed string, n_words int, runs string").repartition(3)
    got = run_digests(periodic_runs(planted(df)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t, *_ in rows:
        w = words_of(i, t)
        runs = brute(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        some = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.append((i, len(runs), *some, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapse(w, runs))))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, *_ in rows if i) > 10
    assert got.count() == len(rows) and got.select("n_runs").count() == len(rows)


def test_whole_results_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "say it say it say it say it now"), (2, None), (None, "")], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(df).collect()}
    assert got == {1: (9, [(0, 8, 2)], "say it now"), 2: (0, [], ""), None: (0, [], "")}
    assert run_digests(periodic_runs(planted(spark.createDataFrame([], "doc_id long, text string")))).count() == 0


def test_a_long_text():
    """A million words: one word throughout, and a long period."""
    n = 1_000_000
    assert find_runs(np.zeros(n, np.int64), np.array([0, n])) == [(0, n, 1)]
    part = np.random.default_rng(2).integers(0, 5000, n // 5)
    got = find_runs(np.tile(part, 5), np.array([0, n]))
    assert (0, n, n // 5) in got
