import datetime as dt

import numpy as np
import pytest
from sensorloom.operators import time_windows as tw

from conftest import START


def plain(rows, minutes):
    """Every window gathered and counted by itself."""
    out = {}
    span = dt.timedelta(minutes=minutes)
    for name in {r[2] for r in rows}:
        own = [(r[1], r[3]) for r in rows if r[2] == name]
        for end in {t for t, _ in own}:
            x = [v for t, v in own if end - span <= t <= end and v is not None]
            out[name, end] = (len(x), *((np.mean(x), np.std(x), min(x), max(x)) if x else (None,) * 4))
    return out


def check(spark, rows, minutes, rows_per_block):
    df = spark.createDataFrame(rows, "row_key bigint, time timestamp, entity_id string, value double").repartition(3)
    got = tw.time_windows(df, ["entity_id"], minutes, rows_per_block).collect()
    want = plain(rows, minutes)
    assert len(got) == len(want)
    for r in got:
        n, *stats = want[r.entity_id, r.window_end]
        assert r.n_points == n
        for a, b in zip((r["mean"], r["std"], r["min"], r["max"]), stats):
            assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9 + 1e-15 * abs(b))


def rows_at(series, value):
    key, rows = 0, []
    for name, times in series.items():
        for m in times:
            rows.append((key, START + dt.timedelta(minutes=float(m)), name, value(key)))
            key += 1
    return rows


def test_sparse_series_and_nulls(spark):
    rng = np.random.default_rng(1)
    series = {"a": np.cumsum(rng.choice([0.5, 1, 7, 40], 150)), "b": [0, 60, 120, 120, 180.5], "c": [3]}
    check(spark, rows_at(series, lambda k: None if k % 6 == 0 else float(rng.normal(50, 9))), 60, 16)


@pytest.mark.parametrize("rows_per_block", [4, 16])
def test_a_burst_in_a_minute(spark, rows_per_block):
    """A third of the rows in a minute, some at one instant: windows reach over many blocks, and blocks of blocks."""
    rng = np.random.default_rng(2)
    calm = np.cumsum(rng.exponential(4, 120))
    burst = 200 + np.sort(rng.integers(0, 60_000, 110)) / 60_000
    series = {"a": [*calm, *burst, *[200.5] * 30], "b": np.cumsum(rng.exponential(10, 60))}
    check(spark, rows_at(series, lambda k: round(float(rng.normal(50, 9)), 2)), 90, rows_per_block)


def test_a_quiet_stretch_beside_large_values(spark):
    values = {k: 1e9 if k < 60 else 95.0 + 0.001 * (k % 2) for k in range(200)}
    check(spark, rows_at({"a": range(200)}, lambda k: values[k]), 10, 8)


def test_tree_answers_any_range():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 33):
        x = rng.normal(size=n)
        tree = tw.Tree((np.ones(n), x, np.zeros(n), x, x))
        first, last = (a.ravel() for a in np.meshgrid(np.arange(n), np.arange(n)))
        first, last = first[first <= last], last[first <= last]
        count, mean, dev, low, high = tree.query(first, last)
        for i, (a, z) in enumerate(zip(first, last)):
            part = x[a : z + 1]
            assert count[i] == len(part) and np.allclose([mean[i], dev[i], low[i], high[i]], [part.mean(), part.var() * len(part), part.min(), part.max()])
