"""Overlaps of mates against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.operators import mates

SWAP = str.maketrans("ACGTN", "TGCAN")
SCHEMA = "name string, seq1 string, qual1 string, seq2 string, qual2 string"


def flip(s):
    return s.translate(SWAP)[::-1]


def brute(a, b, least, most, share):
    best = None
    for offset in range(least - len(b), len(a) - least + 1):
        pairs = [(x, b[i - offset]) for i, x in enumerate(a) if 0 <= i - offset < len(b)]
        unlike = sum(x != y for x, y in pairs)
        if len(pairs) >= least and unlike <= most and unlike <= share * len(pairs):
            key = (unlike / len(pairs), -len(pairs), offset)
            if best is None or key < best[0]:
                best = (key, (offset, len(pairs), unlike))
    return best and best[1]


def test_best_offset():
    rng = random.Random(3)
    for _ in range(400):
        insert = "".join(rng.choice("ACGT") for _ in range(rng.randint(1, 60)))
        a, b = insert[: rng.randint(1, 40)], insert[-rng.randint(1, 40) :]
        a += "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 6)))
        a = "".join(c if rng.random() > 0.04 else rng.choice("ACGTN") for c in a)
        to = lambda s: np.frombuffer(s.encode(), np.uint8)
        assert mates.best_offset(to(a), to(b), 8, 3, 0.2) == brute(a, b, 8, 3, 0.2)


@pytest.fixture(scope="module")
def pairs():
    """Inserts shorter and longer than the reads, with adapters, and errors of low quality; the last ones do not overlap."""
    rng = random.Random(9)
    out = []
    for i in range(120):
        insert = "".join(rng.choice("ACGT") for _ in range(rng.choice([35, 50, 70, 71, 100, 109]) if i < 100 else 200))
        adapter = "AGATCGGAAGAGCACACGTCTGAACTCCAGTCACAGATCGGAAGAGC"
        a, b = (insert + adapter)[:70], (flip(insert) + adapter[::-1])[:70]
        qa, qb = ["I"] * 70, ["I"] * 70
        at = rng.randrange(min(len(insert), 70))
        spot = len(insert) - 1 - at  # the same base of the insert in the mate
        if i % 3 == 0 and 0 <= spot < 70 and len(insert) < 105:
            a = a[:at] + {"A": "C", "C": "A", "G": "T", "T": "G"}[a[at]] + a[at + 1 :]
            qa[at] = "#"
        out.append((f"p{i}", a, "".join(qa), b, "".join(qb), insert))
    return out


def test_overlap_mates(spark, pairs):
    table = spark.createDataFrame([p[:5] for p in pairs] + [("none", None, None, "ACGT", "IIII"), ("short", "ACGT", "IIII", "ACGT", "IIII"), (None, "", "", "", "")], SCHEMA).repartition(3)
    got = {r.name: r for r in mates.overlap_mates(table).collect()}
    for name, a, _, b, _, insert in pairs:
        r = got[name]
        if len(insert) > 110:
            assert r.insert is None and (r.seq1, r.seq2, r.merged_seq) == (a, b, None)
            continue
        assert r.insert == len(insert) and r.merged_seq == insert and len(r.merged_qual) == len(insert)
        assert (r.seq1, r.seq2) == (insert[:70], flip(insert)[:70]) and (len(r.qual1), len(r.qual2)) == (len(r.seq1), len(r.seq2))
        assert r.corrected == r.mismatches
    assert got["none"].insert is None and got["short"].seq1 == "ACGT" and got[None].seq1 == ""
    kept = {r.name: r for r in mates.overlap_mates(table, correct=False).collect()}
    assert any(kept[p[0]].mismatches and kept[p[0]].seq1 != p[5][:70] for p in pairs[:100])
    sizes = {r.insert: r.n for r in mates.insert_sizes(mates.overlap_mates(table)).collect()}
    assert sizes[None] == 23 and sum(sizes.values()) == 123
    with pytest.raises(Exception, match="two lengths"):
        mates.overlap_mates(spark.createDataFrame([("x", "ACG", "II", "A", "I")], SCHEMA)).collect()


@pytest.mark.parametrize(("lengths", "limits", "wrong"), [([70], (30, 5, 0.2), 0.03), ([0, 5, 31, 33, 70, 300], (8, 3, 0.2), 0.03), ([40, 41], (10, 9, 0.5), 0.1)])
def test_many_pairs_as_one_by_one(spark, lengths, limits, wrong, monkeypatch):
    """Batches of reads of one or several lengths give what each pair gives by itself, and no pair is looked at by itself."""
    rng = random.Random(4)
    rows = []
    for i in range(600):
        insert, more = ("".join(rng.choice("ACGT") for _ in range(n)) for n in (rng.randint(1, 150), 80))
        reads = []
        for s in (insert, flip(insert)):
            s = "".join(c if rng.random() > wrong else rng.choice("ACGTNac") for c in (s + more)[: rng.choice(lengths)])
            reads += [s, "".join(rng.choice("#+/5?I") for _ in s)]
        if i % 29 == 0:
            reads[rng.randrange(4)] = None
        rows.append((f"p{i}", *reads))
    want = {n: (None, None, None, None, 0, *r, None, None) if None in r else mates._pair(*r, limits, True, 30, 14) for n, *r in rows}
    assert sum(w[4] for w in want.values()) > 20 < sum(w[0] is None for w in want.values())
    monkeypatch.setattr(mates, "best_offset", None)
    frame = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    assert {r.name: tuple(r)[1:] for r in mates.overlap_mates(frame, *limits).collect()} == want
    parts = [pa.array(c, pa.string()) for c in list(zip(*rows, strict=True))[1:]]
    assert list(zip(*(c.to_pylist() for c in mates._pairs(parts, limits, True, 30, 14)), strict=True)) == list(want.values())


def test_letters_beyond_ascii_and_empty_batches(spark):
    rows = [("x", "ACGTé" * 8, "I" * 40, flip("ACGT" * 10), "I" * 40), ("y", None, None, None, None)]
    got = {r.name: r for r in mates.overlap_mates(spark.createDataFrame(rows, SCHEMA), least=100).collect()}
    assert tuple(got["x"])[6:10] == rows[0][1:] and got["y"].seq1 is None
    assert mates.overlap_mates(spark.createDataFrame([], SCHEMA)).count() == 0
