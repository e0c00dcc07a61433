import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from sensorloom.operators import thresholds


def table(spark, series):
    rows = [(k, None if v is None else float(v)) for k, vs in series.items() for v in vs]
    return spark.createDataFrame(rows, "entity_id string, value double").repartition(3)


@pytest.mark.parametrize("few,bins", [(4096, 4096), (4, 8), (1, 2)])
def test_quantiles_of_skewed_series(spark, few, bins):
    """One series has most of the rows; others are constant, tiny, heavy-tailed or mostly equal."""
    rng = np.random.default_rng(few)
    series = {
        "hot": rng.normal(size=3000).tolist(),
        "flat": [5.0] * 40,
        "one": [2.0],
        "tail": (10 ** rng.uniform(-8, 8, 200)).tolist(),
        "equal": [1.0] * 90 + [2.0] * 10,
        "bad": [None, float("nan"), float("inf"), 3.0, -float("inf")],
        "none": [None, float("nan")],
    }
    df = table(spark, series)
    for level in (0.5, 0.9, 0.98):
        got = {r.entity_id: (r.n, r.value) for r in thresholds.series_quantile(df, ["entity_id"], "value", level, few, bins).collect()}
        for name, xs in series.items():
            xs = sorted(x for x in xs if x is not None and math.isfinite(x))
            assert got.pop(name, None) == ((len(xs), xs[max(math.ceil(level * len(xs)) - 1, 0)]) if xs else None)
        assert not got


def by_hand(xs, level, risk):
    xs = np.sort(xs)
    t = xs[max(math.ceil(level * len(xs)) - 1, 0)]
    y = xs[xs > t] - t
    if not len(y):
        return t, 0, t
    m, v = y.mean(), y.var()
    shape, scale = (0.5 * (1 - m * m / v), 0.5 * m * (1 + m * m / v)) if v > 1e-12 * m * m else (0.0, m)
    share = risk * len(xs) / len(y)
    z = -scale * math.log(share) if abs(shape) < 1e-9 else scale / shape * (share**-shape - 1)
    return t, len(y), t + max(z, 0)


@pytest.mark.parametrize("tail", ["upper", "lower"])
def test_thresholds_by_hand(spark, tail):
    rng = np.random.default_rng(7)
    series = {"normal": rng.normal(50, 5, 2000), "pareto": rng.pareto(4, 1500), "flat": np.full(60, 3.0), "short": np.array([1.0, 2.0, 9.0]), "two": np.r_[np.zeros(97), 1, 1, 1]}
    sign = 1 if tail == "upper" else -1
    df = table(spark, {k: v.tolist() for k, v in series.items()})
    got = {r.entity_id: r for r in thresholds.peak_thresholds(df, ["entity_id"], "value", 0.9, 1e-3, tail).collect()}
    for name, xs in series.items():
        t, n, z = by_hand(sign * xs, 0.9, 1e-3)
        r = got[name]
        assert r.n_rows == len(xs) and r.n_peaks == n
        assert r.peak_level == pytest.approx(sign * t) and r.alert_level == pytest.approx(sign * z)
        assert r.alert_level * sign >= r.peak_level * sign


def test_the_risk_is_met_on_known_distributions(spark):
    """Excesses of exponential and uniform values follow the fitted family: the share beyond the level is near the risk."""
    rng = np.random.default_rng(8)
    series = {"exponential": rng.exponential(2, 40_000), "uniform": rng.uniform(0, 1, 40_000)}
    df = table(spark, {k: v.tolist() for k, v in series.items()})
    levels = thresholds.peak_thresholds(df, ["entity_id"], "value", 0.95, 0.002)
    flagged = thresholds.flag_peaks(df, levels, ["entity_id"], "value")
    share = {r.entity_id: r.share for r in flagged.groupBy("entity_id").agg(F.avg(F.col("is_alert").cast("int")).alias("share")).collect()}
    assert all(0.001 < s < 0.004 for s in share.values())


def test_flags(spark):
    df = table(spark, {"a": [1, 2, 3, None, float("inf")], "b": [5, 50]})
    levels = spark.createDataFrame([("a", 2.0)], "entity_id string, alert_level double")
    got = sorted((r.entity_id, str(r.value), r.is_alert) for r in thresholds.flag_peaks(df, levels, ["entity_id"], "value").collect())
    assert got == [("a", "1.0", False), ("a", "2.0", False), ("a", "3.0", True), ("a", "None", False), ("a", "inf", False), ("b", "5.0", False), ("b", "50.0", False)]
    low = sorted((r.entity_id, str(r.value)) for r in thresholds.flag_peaks(df, levels, ["entity_id"], "value", "lower").where("is_alert").collect())
    assert low == [("a", "1.0")]
    with pytest.raises(ValueError):
        thresholds.peak_thresholds(df, ["entity_id"], "value", 1.5)
    with pytest.raises(ValueError):
        thresholds.flag_peaks(df, levels, ["entity_id"], "value", "both")
