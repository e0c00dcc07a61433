import numpy as np
import pytest
from pyspark.sql import functions as F
from sensorloom.llm import neighbours
from sensorloom.llm.hilbert import hilbert_keys


@pytest.mark.parametrize("n,bits", [(1, 4), (2, 3), (3, 2), (4, 2)])
def test_curve_visits_neighbours(n, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
    keys = hilbert_keys(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(3)


def plain(vectors, ids, asked, k):
    x = np.array(vectors, np.float32).astype(float)
    out = {}
    for q in asked:
        i = ids.index(q)
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        out[q] = sorted((float(s), j) for s, j in zip(d, ids) if j != q)[:k]
    return out


def search(df, k=10, **more):
    out = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 10 == 0, k, **more).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_on_clusters(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16)) * 4
    vectors = (centres[rng.integers(0, 30, 1500)] + rng.normal(size=(1500, 16)) * 0.5).tolist()
    ids = list(range(1500))
    monkeypatch.setattr(neighbours, "UNIT_ROWS", 200)
    monkeypatch.setattr(neighbours, "UNIT_QUERIES", 20)
    got, want = search(table(spark, vectors)), plain(vectors, ids, ids[::10], 10)
    assert got.keys() == want.keys()
    hits = sum(len({j for _, j in got[q]} & {j for _, j in want[q]}) for q in want)
    assert hits >= 0.9 * 10 * len(want)
    x = np.array(vectors, np.float32).astype(float)
    for q in got:
        assert got[q] == sorted(got[q]) and len(got[q]) == 10
        assert all(s == float(np.sqrt(((x[q] - x[j]) ** 2).sum())) or abs(s - np.linalg.norm(x[q] - x[j])) < 1e-12 for s, j in got[q])


def test_ties_and_a_common_vector(spark):
    rng = np.random.default_rng(5)
    vectors = [[1.0, 2.0, 3.0]] * 60 + np.round(rng.normal(size=(40, 3)), 1).tolist() + [[0.0, -0.0, 5.0]] + [[-0.0, 0.0, 5.0]]
    ids = rng.permutation(200)[: len(vectors)].tolist()
    want = plain(vectors, ids, [i for i in ids if i % 10 == 0], 10)
    got = search(table(spark, vectors, ids), target=1.0)
    assert got.keys() == want.keys()
    for q in want:
        assert [j for _, j in got[q]] == [j for _, j in want[q]]


def test_bad_vectors_and_few_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 0], [0, 0], None, [nan, 1], [inf, 1], [None, 1], [], [2, 0], [3, 0, 0], [1, 1], [1, 0]]
    ids = [0, 10, 20, 30, 40, 50, 60, 70, 80, None, 90]
    got = search(table(spark, vectors, ids))
    assert got[0] == [(0.0, 90), (1.0, 70), (1.0, None)]
    assert set(got) == {0, 70, 90}
    assert search(table(spark, [[1, 2]], [0])) == {}
    assert search(table(spark, [])) == {}
    assert search(table(spark, [None, [0, 0]])) == {}
