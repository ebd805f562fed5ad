"""Nearest neighbours: recall against brute force, copies, and odd vectors."""

import numpy as np
import pytest

from hazardflow.llm.neighbours import _pack, _unpack, nearest
from tests.conftest import SF_DIR


def brute(ids, vectors, every, count):
    v = np.array(vectors, np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    out = {}
    for i, q in enumerate(ids):
        if q % every == 0:
            s = v @ v[i]
            order = sorted((j for j in range(len(ids)) if ids[j] != q), key=lambda j: (-round(s[j], 12), ids[j]))[:count]
            out[q] = [(ids[j], s[j]) for j in order]
    return out


def test_recall_on_embeddings(spark):
    rows = spark.read.parquet(f"{SF_DIR.replace('sf0.001', 'sf0.1')}/embeddings.parquet")
    data = rows.collect()
    want = brute([r["vec_id"] for r in data], [r["embedding"] for r in data], 50, 5)
    got = {}
    for r in nearest(rows).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert got.keys() == want.keys()
    hits = sum(len({v for v, _ in g.values()} & {v for v, _ in want[q]}) for q, g in got.items())
    assert hits >= 0.95 * 5 * len(want)
    for q, g in got.items():
        assert sorted(g) == [1, 2, 3, 4, 5] and [g[i][1] for i in sorted(g)] == sorted((s for _, s in g.values()), reverse=True)


def test_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(0)
    same = [1.0, 2.0, 0.0]
    rows = [(i, same) for i in range(40)] + [(100 + i, rng.normal(size=3).tolist()) for i in range(30)]
    bad = [(200, None), (250, []), (300, [0.0, 0.0, 0.0]), (350, [1.0, None, 2.0]), (400, [float("nan"), 1.0, 1.0]), (450, [float("inf"), 0.0, 1.0]), (500, [1.0, 2.0]), (None, same)]
    good = rows + [(600, [1e300, 2e300, 0.0]), (650, [1e-300, 0.0, 3e-300])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in good + bad], "vec_id long, embedding array<double>, node int, rank string")
    got = {}
    for r in sorted(nearest(df).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute([i for i, _ in good], [np.array(v) / np.abs(v).max() for _, v in good], 50, 5)
    assert got.keys() == want.keys()
    assert [v for v, _ in got[0]] == [1, 2, 3, 4, 5]
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]])
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_few_vectors(spark, n):
    df = spark.createDataFrame([(50 * i, [1.0, float(i)]) for i in range(n)], "vec_id long, embedding array<float>")
    assert nearest(df).count() == n * max(0, n - 1)


def test_packing_is_close():
    v = np.random.default_rng(1).normal(size=(20, 64))
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    assert np.abs(_unpack(_pack(v)) - unit).max() < 0.003


def test_dense_groups(spark):
    rng = np.random.default_rng(4)
    rows = []
    for size, noise in ((100, 0.01), (500, 0.01), (500, 0.001), (2000, 0.01)):
        rows += (rng.normal(size=64) + noise * rng.normal(size=(size, 64))).tolist()
    rows += rng.normal(size=(400, 64)).tolist()
    ids = list(range(len(rows)))
    want = brute(ids, rows, 50, 5)
    got = {}
    for r in nearest(spark.createDataFrame(list(zip(ids, rows)), "vec_id long, embedding array<double>")).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    groups = {0: (0, 100), 1: (100, 600), 2: (600, 1100), 3: (1100, 3100)}
    for low, high in groups.values():
        of = [q for q in want if low <= q < high]
        assert sum(len(got[q] & {v for v, _ in want[q]}) for q in of) >= 0.9 * 5 * len(of), (low, high)


def test_one_id_for_several_vectors(spark):
    rows = [(50, [1.0, 0.0, 0.0]), (50, [0.0, 1.0, 0.0]), (100, [0.0, 0.95, 0.05]), (3, [0.0, 0.0, 1.0]), (50, [1.0, 0.0, 0.0])]
    out = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    of_100 = [(r["vec_id"], round(r["score"], 4)) for r in sorted(out, key=lambda r: r["rank"]) if r["query_id"] == 100]
    assert of_100 == [(50, 0.9986), (3, 0.0526), (50, 0.0), (50, 0.0)]
    # the two vectors of id 50 are asked for apart, and their own id is no answer
    lists = [(r["rank"], r["vec_id"]) for r in out if r["query_id"] == 50]
    assert sorted(lists) == [(1, 3), (1, 100), (2, 3), (2, 100)]
