import hashlib

import numpy as np
import pytest
from sensorloom.llm import clustering, lattice


def plain(rows, k, rounds, scale, width):
    """(id, vector) pairs clustered one by one with Python's integers."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centres = [v for _, v in start]
    for i in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres)) for _, v in kept]
        if i < rounds:
            for j in range(len(centres)):
                own = [v for (_, v), (_, c) in zip(kept, found) if c == j]
                if own:
                    centres[j] = [sum(x) // len(own) for x in zip(*own)]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    inertia = {j: sum(d for d, c in found if c == j) for j in range(len(centres))}
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for (i, _), (d, c) in zip(kept, found)), key=repr)


def check(spark, rows, k=4, rounds=3, scale=8, width=3, kind="float"):
    df = spark.createDataFrame([(i, v, "x", 7) for i, v in rows], f"vec_id bigint, embedding array<{kind}>, cluster string, v int").repartition(3)
    found = clustering.cluster(df, k, rounds, scale, width)
    got = sorted((tuple(r) for r in found.rows.collect()), key=repr)
    asked = [(i, v if v is None or kind == "double" else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert got == plain(asked, k, rounds, scale, width)
    return found


def test_equals_plain_clustering(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 6)) * 3
    rows = [(i, (centres[i % 8] + rng.normal(size=6) * 0.3).tolist()) for i in range(600)]
    found = check(spark, rows, k=8, rounds=5, scale=64, width=6)
    # Once centres settle, bounds leave few vectors to be measured against all.
    assert found.scanned[0] == 600 and found.scanned[-1] < 200


def test_noise_ties_and_a_common_vector(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-3, 4, 3).astype(float).tolist()) for i in range(200)] + [(1000 + i, [1.0, 1.0, 1.0]) for i in range(100)]
    check(spark, rows, k=5, rounds=4, scale=1)
    check(spark, [(i, [1.0, 2.0, 3.0]) for i in range(9)])


def test_null_repeated_and_unusable_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, [1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (1, [5.0, 5.0, 5.0]), (1, [5.0, 5.0, 5.0]), (2, None), (3, []), (4, [1.0, 2.0])]
    rows += [(5, [nan, 1.0, 1.0]), (6, [None, 1.0, 1.0]), (7, [inf, 1.0, 1.0]), (8, [0.0, -0.0, 0.0]), (9, [1.0] * 5000)]
    found = check(spark, rows, k=2)
    assert found.rows.count() == 5
    for few in ([], [(1, None)], [(1, [1.0, 2.0, 3.0])]):
        check(spark, few)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(3)
    check(spark, [(i, (rng.normal(size=3) * 3e7).tolist()) for i in range(60)], scale=1, kind="double")
    with pytest.raises(Exception, match="beyond"):
        check(spark, [(1, [1e30, 0.0, 0.0])])


def test_results_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, rng.normal(size=3).tolist()) for i in range(300)], "vec_id bigint, embedding array<double>")
    runs = [sorted(map(tuple, clustering.cluster(df.repartition(n), 6, 3, 64, 3).rows.collect())) for n in (1, 7)]
    assert runs[0] == runs[1]


def test_loosening_bounds_what_a_centre_gains():
    rng = np.random.default_rng(5)
    tighter = 0
    for _ in range(300):
        dim = int(rng.integers(2, 6))
        middle, before, after = rng.normal(size=(3, dim)) * rng.choice([0.3, 1, 5])
        radius = float(rng.uniform(0, 2))
        x = rng.normal(size=(400, dim))
        x = middle + radius * x / np.linalg.norm(x, axis=1)[:, None] * rng.choice([1.0, 0.7], 400)[:, None]
        gain = np.linalg.norm(x - before, axis=1) - np.linalg.norm(x - after, axis=1)
        bound = clustering.loosening(middle, radius, before, after)
        drift = np.linalg.norm(after - before)
        assert gain.max() <= bound + 1e-9 and bound <= drift + 1e-12
        tighter += bound < 0.9 * drift
    assert tighter > 100


def test_integer_roots_and_distances():
    n = np.r_[np.arange(1000), (1 << 27) ** 2 + np.arange(-3, 4), ((1 << 30) + 5) ** 2 - 1, ((1 << 30) + 5) ** 2]
    down, up = lattice.root_down(n), lattice.root_up(n)
    assert ((down**2 <= n) & ((down + 1) ** 2 > n) & (up**2 >= n)).all()
    assert ((up - 1) ** 2 < n)[1:].all()
    rng = np.random.default_rng(6)
    for most in (100, 1 << 26):
        x, c = rng.integers(-most, most, (20, 8)), rng.integers(-most, most, (5, 8))
        assert (lattice.squared_distances(x, c) == ((x[:, None] - c[None]) ** 2).sum(2)).all()
