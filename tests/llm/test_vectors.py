"""Near duplicates of embeddings against all pairs."""

import collections

import numpy as np
import pytest

from tidemark.llm.vectors import hadamard, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, node long, component string, unit binary, bucket int"


def family(rng, centre, n, cos):
    """n vectors about a centre, each at the given cosine to it."""
    noise = rng.normal(size=(n, len(centre)))
    centre = centre / np.linalg.norm(centre)
    noise -= (noise @ centre)[:, None] * centre
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    return cos * centre + np.sqrt(1 - cos * cos) * noise


def expected(rows, least=0.98):
    ids, links, parent = [r[0] for r in rows], collections.Counter(), {}
    unit = []
    for r in rows:
        x = np.array([np.nan if v is None else v for v in r[1]] if r[1] else [np.nan], np.float64)
        unit.append(x / np.linalg.norm(x) if np.isfinite(x).all() and x.any() and r[2] is not None and r[0] is not None else None)

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if unit[a] is None or unit[b] is None or rows[a][2] != rows[b][2] or len(unit[a]) != len(unit[b]) or unit[a] @ unit[b] < least:
                continue
            links[a] += 1
            links[b] += 1
            x, y = sorted((root(ids[a]), root(ids[b])))
            parent[y] = x
    return sorted(((i, links[n], root(i) if i is not None else None) for n, i in enumerate(ids)), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    x = [rng.normal(size=(60, 64))]
    x += [family(rng, rng.normal(size=64), n, cos) for n, cos in ((30, 0.992), (40, 0.999), (25, 0.9897), (12, 0.97), (2, 0.995))]
    centre = rng.normal(size=64)
    x += [family(rng, centre, 1, 0.98 + d) for d in (0.0005, -0.0005)] + [centre[None] * 3.5]
    x = np.concatenate(x).astype(np.float32)
    out = [(int(i), v.tolist(), int(i) % 2 if i > 150 else 1) for i, v in zip(rng.permutation(len(x)), x, strict=True)]
    n = len(out)
    out += [(n, out[70][1], out[70][2]), (n + 1, out[70][1], out[70][2]), (n + 2, out[70][1], None), (n + 3, None, 1), (n + 4, [0.0] * 64, 1), (n + 5, [0.0] * 64, 1)]
    out += [(n + 6, [float("nan")] + [1.0] * 63, 1), (n + 7, [float("inf")] + [1.0] * 63, 1), (n + 8, [None] + [1.0] * 63, 1), (n + 9, [], 1), (None, out[70][1], 1)]
    out += [(n + 10 + k, [1.0, 0.1 * k], 1) for k in range(4)] + [(n + 20, [2.0], 1), (n + 21, [3.0], 1), (n + 22, [-3.0], 1)]
    out += [(n + 30, out[71][1], out[71][2]), (n + 30, out[90][1], out[90][2]), (n + 31, [5.0, 5.0, 5.0], 0), (n + 31, [5.0, 5.0, 5.1], 0)]  # ids with two vectors
    return out


def test_hadamard():
    x = np.random.default_rng(1).normal(size=(5, 64))
    assert np.allclose(hadamard(hadamard(x)), x) and np.allclose((hadamard(x) ** 2).sum(1), (x**2).sum(1))


@pytest.mark.parametrize("chunk", [2048, 8])
def test_near_vectors(spark, rows, chunk):
    df = spark.createDataFrame([(*r, 1, "c", b"u", 2) for r in rows], SCHEMA).repartition(3)
    got = near_vectors(df, chunk=chunk)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = got.collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == expected(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_chain_of_components(spark):
    """Vectors in a row, each linked with its neighbours only: one component, in which only neighbours are linked."""
    turn = [[float(np.cos(0.19 * k)), float(np.sin(0.19 * k))] for k in range(12)]
    rows = [(k, v, 0) for k, v in enumerate(turn)]
    for chunk in (2048, 3):
        got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), chunk=chunk).collect()
        assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == expected(rows)


def test_a_frequent_vector_and_small_tables(spark):
    schema = "vec_id long, embedding array<double>, label int"
    got = near_vectors(spark.createDataFrame([(k, [1.0, 2.0, 3.0], 0) for k in range(500)], schema))
    assert got.where("n_links = 499 AND component_id = 0").count() == 500 and got.where("kept").count() == 1
    assert near_vectors(spark.createDataFrame([], schema)).count() == 0
    assert [tuple(r) for r in near_vectors(spark.createDataFrame([(None, [1.0], 1), (3, None, None)], schema)).orderBy("vec_id").collect()] == [(None, 0, None, True), (3, 0, 3, True)]
