"""Window features against definitions written out value by value."""

import math

import numpy as np
import pytest

from sensorloom.functions.window_features import FEATURES
from sensorloom.operators import quality, windows


def percentile(x, p):
    return float(np.percentile(x, p))


def longest(flags):
    best = run = 0
    for f in flags:
        run = run + 1 if f else 0
        best = max(best, run)
    return best


def correlation(a, b):
    if np.ptp(a) == 0 or np.ptp(b) == 0:
        return None
    return float(np.corrcoef(a, b)[0, 1])


def described(x):
    """The 43 features of one window, one definition at a time."""
    x = np.asarray(x, float)
    n, d = len(x), np.diff(x)
    roc, flat = np.abs(d), np.ptp(x) == 0
    m, sd = x.mean(), 0.0 if flat else x.std()
    z = None if flat else np.abs(x - m) / sd
    q25, q75 = percentile(x, 25), percentile(x, 75)
    rolling = []
    for size, low in ((5, 2), (10, 5)):
        devs = [0.0]
        for i in range(n):
            if i - low >= 0 and i - low + size <= n:
                devs.append(abs(x[i] - x[i - low : i - low + size].mean()))
        rolling.append(max(devs))
    kth = [sorted(abs(x - v))[5] for v in x]
    counts = np.zeros(20)
    for v in x:
        counts[0 if flat else min(int((v - x.min()) * 20 / (x.max() - x.min())), 19)] += 1
    share = counts[counts > 0] / n
    still = sum(x[i : i + 5].std() < 1e-6 for i in range(n - 5))
    outliers = 0 if flat else int((np.round(z, 9) > 3).sum())
    return {
        "max_zscore": None if flat else z.max(),
        "mean_abs_zscore": None if flat else z.mean(),
        "n_zscore_outliers": outliers,
        "iqr": q75 - q25,
        "n_iqr_outliers": sum((v < q25 - 1.5 * (q75 - q25) - 1e-9) or (v > q75 + 1.5 * (q75 - q25) + 1e-9) for v in x),
        "max_deviation_from_median": abs(x - np.median(x)).max(),
        "n_values_above_upper_fence": (x > percentile(x, 95) + 1e-9).sum(),
        "n_values_below_lower_fence": (x < percentile(x, 5) - 1e-9).sum(),
        "max_roc": roc.max(),
        "mean_roc": roc.mean(),
        "std_roc": roc.std(),
        "roc_volatility": np.diff(roc).std(),
        "trend_strength": None if flat else abs(correlation(np.arange(n), x)),
        "n_direction_changes": (np.diff(np.sign(d)) != 0).sum(),
        "is_monotonic_increasing": float((d >= 0).all()),
        "is_monotonic_decreasing": float((d <= 0).all()),
        "consecutive_increases": longest(d > 0),
        "consecutive_decreases": longest(d < 0),
        "autocorr_lag1": correlation(x[:-1], x[1:]),
        "autocorr_lag5": correlation(x[:-5], x[5:]),
        "deviation_from_rolling_mean_5": rolling[0],
        "deviation_from_rolling_mean_10": rolling[1],
        "max_local_outlier_factor": max(kth),
        "skewness": 0.0 if flat else (((x - m) / sd) ** 3).mean(),
        "kurtosis": 0.0 if flat else (((x - m) / sd) ** 4).mean() - 3,
        "max_pct_change": (roc / (abs(x[:-1]) + 1e-6)).max(),
        "consecutive_constants": longest(roc <= 0.01),
        "n_constant_values": (roc <= 0.01).sum(),
        "fraction_constant": (roc <= 0.01).sum() / n,
        "max_abs_change": roc.max(),
        "n_spikes": outliers,
        "spike_ratio": outliers / n,
        "derivative_std": d.std(),
        "high_frequency_noise": math.sqrt((np.diff(d) ** 2).mean()),
        "zero_variance_ratio": still / (n - 5),
        "mean": m,
        "std": sd,
        "median": np.median(x),
        "range": np.ptp(x),
        "coefficient_variation": sd / (m + 1e-6),
        "percentile_25": q25,
        "percentile_75": q75,
        "entropy": -(share * np.log2(share + 1e-10)).sum(),
    }


def extract(readings, size=60, step=1, names=None):
    arranged = quality.arrange_readings(readings, 3)
    table = windows.extract_features(arranged, ["entity_id"], size, step, names)
    return table.toPandas().sort_values(["entity_id", "window_start"]).reset_index(drop=True)


def check(row, values):
    for name, want in described(values).items():
        got = row[name]
        if want is None:
            assert got is None or np.isnan(got), name
        else:
            assert got == pytest.approx(float(want), abs=1e-8), name


def test_there_are_43():
    assert len(FEATURES) == len(set(FEATURES)) == 43
    assert len(windows.MODEL_FEATURES) == 48


def test_random_windows(make):
    rng = np.random.default_rng(2)
    series = {
        "gauss": np.round(rng.normal(90, 3, 75), 2),
        "steps": 90 + rng.integers(0, 3, 75),
        "heavy": np.round(rng.exponential(50, 75), 2),
        "stuck": np.r_[np.round(rng.normal(90, 3, 20), 2), np.full(55, 95.0)],
    }
    table = extract(make(series))
    assert len(table) == 4 * 16
    for name, rows in table.groupby("entity_id"):
        for i, (_, row) in enumerate(rows.iterrows()):
            check(row, series[name][i : i + 60])


def test_constant_window(make):
    row = extract(make({"e": [95.0] * 60})).iloc[0]
    assert row["std"] == row["skewness"] == row["kurtosis"] == 0
    assert all(row[c] is None or np.isnan(row[c]) for c in ("max_zscore", "trend_strength", "autocorr_lag1", "autocorr_lag5"))
    assert row["consecutive_constants"] == 59
    assert row["fraction_constant"] == pytest.approx(59 / 60)
    assert row["zero_variance_ratio"] == 1
    assert row["is_monotonic_increasing"] == row["is_monotonic_decreasing"] == 1
    assert row["entropy"] == pytest.approx(-1.44e-10, rel=0.01)


def test_ramp(make):
    row = extract(make({"e": range(1, 61)})).iloc[0]
    assert row["trend_strength"] == pytest.approx(1)
    assert row["autocorr_lag1"] == pytest.approx(1)
    assert row["consecutive_increases"] == 59
    assert row["n_direction_changes"] == 0
    assert row["max_local_outlier_factor"] == 5
    assert row["range"] == 59
    assert row["high_frequency_noise"] == 0


def test_zigzag(make):
    row = extract(make({"e": [(-1) ** i for i in range(60)]})).iloc[0]
    assert row["n_direction_changes"] == 58
    assert row["autocorr_lag1"] == pytest.approx(-1)
    assert row["max_roc"] == 2
    assert row["high_frequency_noise"] == pytest.approx(4)


def test_short_windows(make):
    """Sizes below the lags and frames of some features."""
    values = np.round(np.random.default_rng(3).normal(0, 1, 9), 2)
    for size in (2, 4, 6):
        table = extract(make({"e": values}), size=size)
        assert len(table) == 9 - size + 1
        assert np.allclose(table["mean"], [values[i : i + size].mean() for i in range(len(table))])


def test_unrequested_groups_are_not_evaluated(make):
    assert windows.needed_groups(["max_roc"]) == ["collective"]
    assert windows.needed_groups(["n_points", "min_oxygen"]) == []
    assert windows.needed_groups(["mean_oxygen", "iqr", "spike_ratio"]) == ["distribution", "fault", "point"]
    arranged = quality.arrange_readings(make({"e": range(70)}))
    table = windows.extract_features(arranged, ["entity_id"], 60, 1, ["max_roc"])
    assert table.columns[-1] == "max_roc" and table.count() == 11
