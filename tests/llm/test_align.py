"""Alignment of two tokenizers against brute force."""

import collections
import functools
import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import align as al
from tidemark.llm.align import Fragment, align, compose, finished, fragment


def tokens(text):
    """Ids and bytes of A and B, by the libraries on the whole text; nothing if either does not spell it."""
    x, y = al._encoder_a(al.public_pair().a)([" " + text])[0], al._model_b(al.public_pair().b).encode(text)
    side = al.sides(al.public_pair())
    bytes_of = [[side[k].tokens[i].as_py() for i in ids] for k, ids in enumerate((x, y))]
    spelled = bool(text) and all(b"".join(b) == (" " + text).encode() for b in bytes_of)
    return (x, y, *bytes_of) if spelled else ([], [], [], [])


def brute(text):
    """n_a, n_b, groups, links of a text."""
    x, y, bx, by = tokens(text or "")
    ends = [np.cumsum([len(t) for t in b]).tolist() for b in (bx, by)]
    groups, last = [], (0, 0)
    for end in sorted(set(ends[0]) & set(ends[1])):
        now = (ends[0].index(end) + 1, ends[1].index(end) + 1)
        groups.append((x[last[0] : now[0]], y[last[1] : now[1]]))
        last = now
    links, j = [], 0
    for i, (a, e) in enumerate(zip(x, ends[0], strict=True)):
        while j and ends[1][j - 1] > e - len(bx[i]):
            j -= 1
        while j < len(y) and ends[1][j] - len(by[j]) < e:
            if ends[1][j] > e - len(bx[i]):
                links.append((a, y[j]))
            j += 1
    return len(x), len(y), groups, links


def expected(rows):
    found = [(i, *brute(t)) for i, t in rows]
    count = collections.Counter(p for f in found for p in set(f[4]))
    most = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    out = []
    for i, n_a, n_b, groups, links in found:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        best = sum(count[p] == most[p[0]] for p in links)
        out.append((i, n_a, n_b, len(groups), len(links), best, sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if n_a else ""))
    return sorted(out, key=str), found


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    letters = "aeionrstlémuhß ÀΣ日本🙂'-.,;:!?\n\t0123456789 　 <|>_"
    vocabulary = ["".join(rng.choice("aeionrstlmuh") for _ in range(rng.randint(1, 9))) for _ in range(200)]
    texts = [" ".join(rng.choice(vocabulary) + rng.choice(["", "", ",", ".", ".\n", "  "]) for _ in range(rng.randint(1, 150))) for _ in range(40)]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 200))) for _ in range(80)]
    texts += [None, "", " ", "   ", "\n", "a", "<|endoftext|>", "foo <|endoftext|> bar", "</s> x <s>", "▁ mark", "a▁b", "don't, we'll", "x" * 700, "é" * 300, "日本語" * 200, "a\x00b c", "tail   ", "  head", "  x 　 y", "ﬁ ﬁ", "é"]
    texts += [" ".join(rng.choice(vocabulary) for _ in range(3000)), texts[0], texts[1]]
    return list(enumerate(texts)) + [(None, "null id"), (3, texts[3])]


@pytest.mark.parametrize(("piece", "fan"), [(1 << 16, 16), (64, 3)])
def test_align(spark, rows, piece, fan):
    df = spark.createDataFrame([(*r, 1, "p", None) for r in rows], "doc_id long, text string, block int, pair string, data binary").repartition(3)
    got = align(df, piece=piece, fan=fan, digest=True)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want, _ = expected(rows)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert got.count() == len(rows) and got.select("n_a").where("n_a > 0").count() == sum(w[1] > 0 for w in want)


def test_whole_groups(spark, rows):
    some = rows[:60]
    got = {r.doc_id: [(g.a, g.b) for g in r.groups] for r in align(spark.createDataFrame(some, "doc_id long, text string"), piece=200).collect()}
    assert got == {i: f[3] for i, f in zip([r[0] for r in some], ([None, *f[1:]] for f in expected(some)[1]), strict=True)}


def test_small_tables(spark):
    assert align(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert [tuple(r) for r in align(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), digest=True).orderBy("doc_id").collect()] == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_fragments_compose_in_any_order():
    rng = random.Random(9)
    size = (np.array([1, 2, 3, 4]), np.array([1, 3, 2, 5]))
    for _ in range(300):
        ids = [[], []]
        while sum(size[0][i] for i in ids[0]) != sum(size[1][i] for i in ids[1]) or not ids[0]:
            k = int(sum(size[0][i] for i in ids[0]) > sum(size[1][i] for i in ids[1]))
            ids[k].append(rng.randint(0, 3))
            if len(ids[0]) < 12 and rng.random() < 0.5:
                ids[0].append(rng.randint(0, 3))
        ids = [np.array(x) for x in ids]
        cuts = [sorted(rng.randint(0, len(x)) for _ in range(4)) for x in ids]
        cuts = [[0, *c, len(x)] for c, x in zip(cuts, ids, strict=True)]
        parts = [fragment(tuple(x[c[n] : c[n + 1]] for x, c in zip(ids, cuts, strict=True)), np.array([size[k][ids[k][: cuts[k][n]]].sum() for k in range(2)]), size) for n in range(5)]
        whole = finished(fragment(tuple(ids), np.zeros(2, np.int64), size))
        both = lambda f, g: compose(Fragment.unpack(f.pack()), g, size)
        left = functools.reduce(both, parts)
        right = functools.reduce(lambda g, f: both(f, g), reversed(parts))
        tree = both(both(parts[0], parts[1]), both(both(parts[2], parts[3]), parts[4]))
        for f in (left, right, tree):
            assert all((a == b).all() and len(a) == len(b) for a, b in zip(finished(f), whole, strict=True))
