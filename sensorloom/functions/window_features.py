"""The 43 window features.

Spark spreads blocks of consecutive readings (operators/windows.py); a task cuts the windows of a
block as an n x W view and gives it to these functions, one for each of the five groups. Frames cannot express order statistics,
runs, nearest-value distances and histograms, and for the moment features sliding frames cost
several times more than one pass over the batch (README, "Window features").

Null marks undefined ratios of constant windows; spread and moments of a constant window are
exactly 0. Comparisons against computed bounds are made on 9 decimals, so that they do not
depend on the order of summation.
"""

from __future__ import annotations

import numpy as np

# Fixed values.
NEIGHBOURS = 5
FLAT_TOLERANCE = 0.01
FLAT_ROWS = 5
FLAT_STD = 1e-6
ENTROPY_BINS = 20
RATIO_GUARD = 1e-6
LOG_GUARD = 1e-10

POINT = (
    "max_zscore",
    "mean_abs_zscore",
    "n_zscore_outliers",
    "iqr",
    "n_iqr_outliers",
    "max_deviation_from_median",
    "n_values_above_upper_fence",
    "n_values_below_lower_fence",
)
COLLECTIVE = (
    "max_roc",
    "mean_roc",
    "std_roc",
    "roc_volatility",
    "trend_strength",
    "n_direction_changes",
    "is_monotonic_increasing",
    "is_monotonic_decreasing",
    "consecutive_increases",
    "consecutive_decreases",
    "autocorr_lag1",
    "autocorr_lag5",
)
CONTEXTUAL = (
    "deviation_from_rolling_mean_5",
    "deviation_from_rolling_mean_10",
    "max_local_outlier_factor",
    "skewness",
    "kurtosis",
    "max_pct_change",
)
FAULT = (
    "consecutive_constants",
    "n_constant_values",
    "fraction_constant",
    "max_abs_change",
    "n_spikes",
    "spike_ratio",
    "derivative_std",
    "high_frequency_noise",
    "zero_variance_ratio",
)
DISTRIBUTION = (
    "mean",
    "std",
    "median",
    "range",
    "coefficient_variation",
    "percentile_25",
    "percentile_75",
    "entropy",
)
GROUPS = {
    "point": POINT,
    "collective": COLLECTIVE,
    "contextual": CONTEXTUAL,
    "fault": FAULT,
    "distribution": DISTRIBUTION,
}
FEATURES = tuple(name for names in GROUPS.values() for name in names)


def _std(x: np.ndarray) -> np.ndarray:
    """Population deviation per row, exactly 0 where a row is constant."""
    return np.where((x == x[:, :1]).all(1), 0.0, x.std(1))


def _over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a / b, NaN (null) where b is 0."""
    return np.divide(a, b, out=np.full(a.shape, np.nan), where=b != 0)


def _percentile(s: np.ndarray, p: float) -> np.ndarray:
    at = p * (s.shape[1] - 1)
    low = int(at)
    high = min(low + 1, s.shape[1] - 1)
    return s[:, low] + (s[:, high] - s[:, low]) * (at - low)


def _correlation(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    spread = _std(x) * _std(y)
    x, y = x - x.mean(1, keepdims=True), y - y.mean(1, keepdims=True)
    return _over((x * y).mean(1), spread)


def _longest_run(flags: np.ndarray) -> np.ndarray:
    run = longest = np.zeros(len(flags))
    for step in np.ascontiguousarray(flags.T):
        run = (run + 1) * step
        longest = np.maximum(longest, run)
    return longest


def _point(x: np.ndarray) -> dict[str, np.ndarray]:
    s, dev, sd = np.sort(x, 1), np.abs(x - x.mean(1, keepdims=True)), _std(x)
    z = _over(dev, np.broadcast_to(sd[:, None], x.shape))
    q25, q75, median = _percentile(s, 0.25), _percentile(s, 0.75), _percentile(s, 0.5)
    iqr = q75 - q25
    below = np.round(x - (q25 - 1.5 * iqr)[:, None], 9) < 0
    above = np.round(x - (q75 + 1.5 * iqr)[:, None], 9) > 0
    return dict(
        max_zscore=z.max(1),
        mean_abs_zscore=z.mean(1),
        n_zscore_outliers=(np.round(z, 9) > 3).sum(1),
        iqr=iqr,
        n_iqr_outliers=(below | above).sum(1),
        max_deviation_from_median=np.maximum(s[:, -1] - median, median - s[:, 0]),
        n_values_above_upper_fence=(np.round(x - _percentile(s, 0.95)[:, None], 9) > 0).sum(1),
        n_values_below_lower_fence=(np.round(x - _percentile(s, 0.05)[:, None], 9) < 0).sum(1),
    )


def _collective(x: np.ndarray) -> dict[str, np.ndarray]:
    d = np.diff(x, axis=1)
    roc = np.abs(d)
    index = np.broadcast_to(np.arange(x.shape[1], dtype=float), x.shape)
    zero = np.zeros(len(x))
    lagged = lambda k: _correlation(x[:, :-k], x[:, k:]) if x.shape[1] > k + 1 else zero
    return dict(
        max_roc=roc.max(1),
        mean_roc=roc.mean(1),
        std_roc=_std(roc),
        roc_volatility=_std(np.diff(roc, axis=1)) if roc.shape[1] > 1 else zero,
        trend_strength=np.abs(_correlation(index, x)),
        n_direction_changes=(np.diff(np.sign(d), axis=1) != 0).sum(1),
        is_monotonic_increasing=(d >= 0).all(1),
        is_monotonic_decreasing=(d <= 0).all(1),
        consecutive_increases=_longest_run(d > 0),
        consecutive_decreases=_longest_run(d < 0),
        autocorr_lag1=lagged(1),
        autocorr_lag5=lagged(5),
    )


def _frames(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Column k of every run of ``size`` neighbouring values, for k = 0 .. size-1."""
    count = x.shape[1] - size + 1
    return [x[:, k : k + count] for k in range(size)]


def _rolling_deviation(x: np.ndarray, size: int) -> np.ndarray:
    """Largest distance to the centred rolling mean; rows without a full frame count as 0."""
    if x.shape[1] < size:
        return np.zeros(len(x))
    frames = _frames(x, size)
    return np.abs(frames[size // 2] - sum(frames) / size).max(1)


def _neighbour_distance(s: np.ndarray, k: int) -> np.ndarray:
    """Largest distance of a value to its k-th nearest other value.

    In sorted order the k nearest lie in one of the k+1 stretches that contain the value, so
    the distance matrix is not needed.
    """
    n = s.shape[1]
    if n <= k:
        return np.zeros(len(s))
    nearest = np.full(s.shape, np.inf)
    for left in range(k + 1):
        at = slice(left, n - k + left)
        reach = np.maximum(s[:, at] - s[:, : n - k], s[:, k:] - s[:, at])
        nearest[:, at] = np.minimum(nearest[:, at], reach)
    return nearest.max(1)


def _contextual(x: np.ndarray) -> dict[str, np.ndarray]:
    sd, dev = _std(x), x - x.mean(1, keepdims=True)
    square = dev * dev
    shape = lambda m, p: np.nan_to_num(_over(m, sd**p))
    return dict(
        deviation_from_rolling_mean_5=_rolling_deviation(x, 5),
        deviation_from_rolling_mean_10=_rolling_deviation(x, 10),
        max_local_outlier_factor=_neighbour_distance(np.sort(x, 1), NEIGHBOURS),
        skewness=shape((square * dev).mean(1), 3),
        kurtosis=np.where(sd > 0, shape((square * square).mean(1), 4) - 3, 0.0),
        max_pct_change=np.abs(np.diff(x, axis=1) / (np.abs(x[:, :-1]) + RATIO_GUARD)).max(1),
    )


def _fault(x: np.ndarray) -> dict[str, np.ndarray]:
    n = x.shape[1]
    d = np.diff(x, axis=1)
    flat = np.abs(d) <= FLAT_TOLERANCE
    n_flat, zero = flat.sum(1), np.zeros(len(x))
    sd = _std(x)
    z = _over(np.abs(x - x.mean(1, keepdims=True)), np.broadcast_to(sd[:, None], x.shape))
    n_spikes = (np.round(z, 9) > 3).sum(1)
    still = zero
    if n > FLAT_ROWS:
        frames = _frames(x[:, :-1], FLAT_ROWS)
        mean = sum(frames) / FLAT_ROWS
        still = (np.sqrt(sum((f - mean) ** 2 for f in frames) / FLAT_ROWS) < FLAT_STD).mean(1)
    return dict(
        consecutive_constants=_longest_run(flat),
        n_constant_values=n_flat,
        fraction_constant=n_flat / n,
        max_abs_change=np.abs(d).max(1),
        n_spikes=n_spikes,
        spike_ratio=n_spikes / n,
        derivative_std=_std(d),
        high_frequency_noise=np.sqrt((np.diff(d, axis=1) ** 2).mean(1)) if n > 2 else zero,
        zero_variance_ratio=still,
    )


def _entropy(x: np.ndarray, low: np.ndarray, spread: np.ndarray) -> np.ndarray:
    n, size = x.shape
    bins = min(ENTROPY_BINS, size)
    scaled = (x - low[:, None]) * bins / np.where(spread == 0, 1.0, spread)[:, None]
    cell = np.minimum(scaled.astype(np.int64), bins - 1) + np.arange(n)[:, None] * bins
    share = np.bincount(cell.ravel(), minlength=n * bins).reshape(n, bins) / size
    return -(share * np.log2(share + LOG_GUARD)).sum(1)


def _distribution(x: np.ndarray) -> dict[str, np.ndarray]:
    s, mean, sd = np.sort(x, 1), x.mean(1), _std(x)
    spread = s[:, -1] - s[:, 0]
    return dict(
        mean=mean,
        std=sd,
        median=_percentile(s, 0.5),
        range=spread,
        coefficient_variation=_over(sd, mean + RATIO_GUARD),
        percentile_25=_percentile(s, 0.25),
        percentile_75=_percentile(s, 0.75),
        entropy=_entropy(x, s[:, 0], spread),
    )


_OF_GROUP = {
    "point": _point,
    "collective": _collective,
    "contextual": _contextual,
    "fault": _fault,
    "distribution": _distribution,
}


def group_features(group: str, windows: np.ndarray) -> dict[str, np.ndarray]:
    """All features of one group for an n x W matrix of full windows; NaN where undefined."""
    return _OF_GROUP[group](windows)
