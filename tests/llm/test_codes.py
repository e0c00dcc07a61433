import hashlib

import numpy as np
import pytest
from sensorloom.llm import codes


def plain(rows, parts, entries, rounds, scale):
    """(id, label, vector) coded part by part with Python's integers."""
    usable = [(i, t, [int(np.floor(scale * float(x))) for x in v]) for i, t, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    lengths = [len(v) for *_, v in usable if v and len(v) % parts == 0]
    width = min(set(lengths), key=lambda n: (-lengths.count(n), n)) if lengths else 0
    kept = [r for r in usable if len(r[2]) == width and width]
    start = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    w, code, error, numbers = width // parts, [""] * len(kept), [0] * len(kept), []
    for p in range(parts):
        cut = [v[p * w : p * w + w] for *_, v in kept]
        book = [v[p * w : p * w + w] for *_, v in start]
        for i in range(rounds + 1):
            found = [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(book)) for v in cut]
            if i < rounds:
                for j in range(len(book)):
                    own = [v for v, (_, c) in zip(cut, found) if c == j]
                    if own:
                        book[j] = [sum(x) // len(own) for x in zip(*own)]
        code = [c + f"{j:02x}" for c, (_, j) in zip(code, found)]
        error = [e + d for e, (d, _) in zip(error, found)]
        numbers += [str(x) for c in book for x in c]
    digest = hashlib.sha256(",".join(numbers).encode()).hexdigest()
    of = {t: sum(e for e, (_, u, _) in zip(error, kept) if u == t) for t in {t for _, t, _ in kept}}
    return sorted(((i, c, e, of[t], digest) for (i, t, _), c, e in zip(kept, code, error)), key=repr)


def check(spark, rows, parts=2, entries=6, rounds=4, scale=16, kind="float"):
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], f"vec_id bigint, label int, embedding array<{kind}>, code string, slot int").repartition(3)
    found = codes.compress(df, parts, entries, rounds, scale)
    asked = [(i, t, v if v is None or kind == "double" else [None if x is None else float(np.float32(x)) for x in v]) for i, t, v in rows]
    assert sorted((tuple(r) for r in found.rows.collect()), key=repr) == plain(asked, parts, entries, rounds, scale)
    return found


def test_equals_plain_coding(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(10, 8)) * 2
    rows = [(i, int(rng.integers(0, 3)), (centres[rng.integers(0, 10)] + rng.normal(size=8) * 0.2).tolist()) for i in range(500)]
    found = check(spark, rows, parts=4, entries=12, rounds=7, scale=256)
    b, needed = found.needed[-1]
    assert needed[0] > 0.8 * sum(needed.values())  # most parts are settled by their bounds alone
    assert all(sum(n.values()) == 2000 for _, n in found.needed)


def test_noise_ties_and_a_common_vector(spark):
    rng = np.random.default_rng(2)
    rows = [(i, None if i % 3 else 1, rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(200)]
    rows += [(1000 + i, 5, [1.0] * 6) for i in range(100)]
    check(spark, rows, parts=3, entries=16, rounds=6, scale=1)
    check(spark, [(i, 1, [2.0, 2.0]) for i in range(9)])


@pytest.mark.parametrize("entries", [1, 2, 3])
def test_few_entries(spark, entries):
    rng = np.random.default_rng(3)
    check(spark, [(i, i % 2, rng.normal(size=4).tolist()) for i in range(50)], entries=entries)


def test_null_repeated_and_unusable_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(None, None, [1.0, 2.0, 3.0, 4.0])] * 2 + [(7, 1, [0.5, 0.5, 0.5, 0.5])] * 3 + [(2, 1, None), (3, 1, []), (4, 2, [1.0, 2.0, 3.0])]
    rows += [(5, 1, [nan, 0.0, 0.0, 0.0]), (6, 1, [None, 0.0, 0.0, 0.0]), (8, 1, [inf, 0.0, 0.0, 0.0]), (9, 9, [0.0] * 4), (10, 9, [0.0] * 6000)]
    assert check(spark, rows).rows.count() == 6
    for few in ([], [(1, 1, None)], [(1, None, [1.0, 2.0])]):
        check(spark, few)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    check(spark, [(i, 1, (rng.normal(size=4) * 2e7).tolist()) for i in range(80)], scale=1, kind="double")
    with pytest.raises(Exception, match="beyond"):
        check(spark, [(1, 1, [1e30, 0.0])])


@pytest.mark.parametrize("b", [1, 2, 5])
def test_bounds_hold_whatever_b_does(b):
    rng = np.random.default_rng(b)
    x, book = rng.integers(-50, 50, (400, 3)), rng.integers(-50, 50, (9, 3))
    s, _ = codes.scan(x, book, b)
    for _ in range(8):
        after = book + rng.integers(-6, 7, book.shape) * rng.integers(0, 2, (9, 1))
        moved = codes.root_up(((after - book) ** 2).sum(1))
        wide = int(rng.integers(1, 8))
        s, needed = codes.advance(x, s, after, moved, wide)
        book = after
        d = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (s.at == d.argmin(1)).all() and (s.above**2 >= d.min(1)).all()
        assert s.near.shape == (400, wide) and needed.max() <= 10
        for i in range(len(x)):
            kept = {int(e): int(v) for e, v in zip(s.near[i], s.low[i]) if e >= 0}
            assert len(kept) == (s.near[i] >= 0).sum() and s.at[i] not in kept
            for e in set(range(9)) - {int(s.at[i])}:
                bound = max(kept.get(e, s.outer[i]), 0)
                assert bound**2 <= d[i, e]


def test_adapted():
    assert codes.adapted(4, {0: 990, 1: 10}, 16) == 2
    assert codes.adapted(4, {0: 900, 3: 95, 5: 5}, 16) == 3
    assert codes.adapted(4, {0: 900, 5: 100}, 16) == 8
    assert codes.adapted(8, {9: 1000}, 16) == 14
