import numpy as np
import pytest

from sensorloom.operators import impute, quality


def values(df):
    rows = df.toPandas().sort_values(["entity_id", "row_key"])
    return {k: g["value"].to_numpy() for k, g in rows.groupby("entity_id")}


def holes(x, at):
    return [None if i in at else v for i, v in enumerate(x)]


def arranged(make, series, chunks=3):
    return quality.arrange_readings(make(series), chunks)


def test_forward_fill_leaves_leading_nulls(make):
    got = values(impute.forward_fill(arranged(make, {"e": [None, None, 3, None, 5, None]})))["e"]
    assert np.array_equal(got, [np.nan, np.nan, 3, 3, 5, 5], equal_nan=True)


def test_neighbour_mean_is_the_series_mean(make):
    got = values(impute.neighbour_mean(make({"a": [1, None, 3], "b": [None, 10.0], "none": [None, None]})))
    assert got["a"].tolist() == [1, 2, 3]
    assert got["b"].tolist() == [10, 10]
    assert np.isnan(got["none"]).all()


def test_ensemble_equals_mean_on_one_column(make):
    series = {"a": [1, None, 3, 8]}
    assert values(impute.impute(arranged(make, series), "ensemble"))["a"].tolist() == [1, 4, 3, 8]


def test_spline_reproduces_a_cubic(make):
    t = np.arange(60.0)
    x = 2 + t - 0.05 * t**2 + 0.001 * t**3
    got = values(impute.spline(arranged(make, {"e": holes(x, {0, 1, 17, 18, 19, 40, 58, 59})})))["e"]
    assert np.allclose(got, x, atol=1e-9)


def test_spline_on_blocks_equals_one_solve(make):
    rng = np.random.default_rng(5)
    x = holes(np.cumsum(rng.normal(0, 1, 700)), set(rng.choice(700, 150, replace=False)))
    whole = values(impute.spline(arranged(make, {"e": x}, 1)))["e"]
    cut = values(impute.spline(arranged(make, {"e": x}, 5), block_knots=64))["e"]
    assert np.allclose(whole, cut, atol=1e-9)


def test_spline_with_few_known_values(make):
    series = {"three": [None, 1, None, 2, None, 3, None], "one": [None, 7, None], "none": [None, None]}
    got = values(impute.spline(arranged(make, series)))
    assert np.array_equal(got["three"], [np.nan, 1, 1, 2, 2, 3, 3], equal_nan=True)
    assert np.array_equal(got["one"], [np.nan, 7, np.nan], equal_nan=True)
    assert np.isnan(got["none"]).all()


def test_counts_and_dispatch(make):
    before = arranged(make, {"e": [None, 2, None]})
    counts = impute.missing_counts(before, impute.impute(before, "forward_fill")).first()
    assert (counts.nulls_before, counts.nulls_after) == (2, 1)
    with pytest.raises(ValueError):
        impute.impute(before, "other")


def nearest_by_hand(rows, k):
    """rows: (minute, value or None) in order; every null against every known reading."""
    known = [(m, i, v) for i, (m, v) in enumerate(rows) if v is not None]
    out = []
    for i, (m, v) in enumerate(rows):
        near = sorted((abs(m - a), abs(i - j), j, w) for a, j, w in known)[:k]
        out.append(v if v is not None else np.mean([w for *_, w in near]) if near else np.nan)
    return out


@pytest.mark.parametrize("k,block_knots", [(1, 4), (5, 4), (5, 4096), (40, 8), (500, 16)])
def test_nearest_in_time_over_chunk_borders(make, k, block_knots):
    """k reaches over chunks and blocks, and beyond the series; one null run is longer than a chunk."""
    rng = np.random.default_rng(k)
    minutes = {"a": np.cumsum(rng.choice([0, 0.5, 1, 9], 150)).tolist(), "b": list(range(60)), "none": [0, 1], "one": [0, 5, 7]}
    series = {"a": holes(rng.normal(50, 5, 150).round(2).tolist(), {0, 1, 7, 149, *range(40, 110)}), "none": [None, None], "one": [None, 3.0, None]}
    series["b"] = holes(rng.normal(50, 5, 60).round(2).tolist(), set(range(0, 60, 2)))
    placed = quality.arrange_readings(make(series, minutes), 7)
    got = values(impute.nearest_in_time(placed, k, block_knots=block_knots))
    for name in series:
        want = nearest_by_hand(list(zip(minutes[name], series[name])), k)
        np.testing.assert_allclose(got[name], want, rtol=1e-12, equal_nan=True)


def test_nearest_in_time_by_dispatch(make):
    placed = quality.arrange_readings(make({"a": [1.0, None, 3.0]}))
    assert values(impute.impute(placed, "knn_time"))["a"].tolist() == [1, 2, 3]
    with pytest.raises(ValueError):
        impute.nearest_in_time(placed, 0)
