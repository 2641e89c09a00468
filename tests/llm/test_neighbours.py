"""Nearest neighbours: recall and exact scores against brute force, the rotation, copies, odd rows."""

import numpy as np
import pytest

from skywell.llm import neighbours
from skywell.llm.neighbours import hadamard, nearest, sides, signs
from tests.compare import database


def brute(ids, x, wanted=20, every=20):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = (x * x[i]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -score)) if j != i][:wanted]
        out[int(ids[i])] = [(int(ids[j]), score[j]) for j in order]
    return out


def test_query_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = database(sf).execute("select vec_id, embedding from embeddings").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    want = brute(ids, x)
    got = {}
    for r in neighbours.op2_neighbours(spark, sf).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(want)
    hits = 0
    for q, found in got.items():
        pairs = [found[k] for k in range(1, 21)]
        assert pairs == sorted(pairs, key=lambda p: (-p[1], p[0])) and q not in {p[0] for p in pairs}
        truth = dict(zip(ids.tolist(), (x * x[ids == q][0]).sum(axis=1)))
        assert all(abs(truth[v] - s) < 1e-12 for v, s in pairs)
        hits += len({p[0] for p in pairs} & {v for v, _ in want[q]})
    assert hits / (20 * len(want)) >= 0.9


def test_rotations_keep_lengths_and_angles():
    x = np.random.default_rng(0).normal(size=(50, 64))
    y = sides(x, signs(3, 64, 1)[2])[:, :64]
    np.testing.assert_allclose(y @ y.T, x @ x.T, atol=1e-9)
    want = np.array([[1 - 2 * (bin(i & j).count("1") & 1) for j in range(8)] for i in range(8)]) / np.sqrt(8)
    np.testing.assert_allclose(hadamard(np.eye(8)), want)


@pytest.mark.parametrize("scale", [False, True])
def test_small_tables_are_complete(spark, scale):
    """Copies make a hot bucket and ties; a table smaller than the wanted number gives all candidates."""
    r = np.random.default_rng(5)
    x = r.normal(size=(30, 6))
    x[10:20] = x[10]
    if scale:
        x[20:] *= 3
    else:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, row.tolist(), 1.0) for i, row in enumerate(x)]
    rows += [(40, None, 1.0), (60, [], 1.0), (80, [0.0] * 6, 1.0), (100, [float("nan")] + [1.0] * 5, 1.0), (120, [None] + [1.0] * 5, 1.0),
             (140, [float("inf")] * 6, 1.0), (None, [1.0] * 6, 1.0), (0, rows[0][1], 1.0), (160, [1.0, 2.0], 1.0), (161, [2.0, 1.0], 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double").repartition(4)
    want = brute(np.arange(30), x, wanted=29, every=5)
    got = {}
    for row in nearest(df, lambda k: k % 5 == 0, wanted=29).orderBy("query_id", "rank").collect():
        got.setdefault(row.query_id, []).append((row.vec_id, row.score))
    assert got.pop(160) == [(161, 4.0)]
    assert {q: [v for v, _ in p] for q, p in got.items()} == {q: [v for v, _ in p] for q, p in want.items()}
    assert nearest(df.limit(0), lambda k: k % 5 == 0).count() == 0


def test_a_hot_vector_is_split_into_cells(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL", 16)
    r = np.random.default_rng(6)
    x = r.normal(size=(300, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:120] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    got = nearest(df, lambda k: k % 20 == 0, tables=8).collect()
    for q in (0, 20, 100):
        assert [v.vec_id for v in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == [i for i in range(22) if i != q][:20]


@pytest.mark.parametrize("kind", ["outlier", "lognormal"])
def test_recall_on_unequal_lengths(spark, kind):
    r = np.random.default_rng(7)
    x = r.normal(size=(6000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "outlier":
        x[17] *= 10
    else:
        x *= r.lognormal(0, 0.5, size=(len(x), 1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    want = brute(np.arange(len(x)), x, every=100)
    hits = 0
    for row in nearest(df, lambda k: k % 100 == 0).collect():
        hits += row.vec_id in {v for v, _ in want[row.query_id]}
    assert hits / (20 * len(want)) >= 0.9
