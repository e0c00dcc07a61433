import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from sensorloom.operators import alerts

from conftest import START

AT = lambda m: START + dt.timedelta(minutes=float(m))


def windows_of(spark, series, span=30):
    rows = [(k, AT(10 * i), AT(10 * i + span), s, v) for k, xs in series.items() for i, (s, v) in enumerate(xs)]
    return spark.createDataFrame(rows, "entity_id string, window_start timestamp, window_end timestamp, score double, mean_oxygen double").repartition(3)


def by_hand(xs, bands, high, low, n_open, n_close):
    """The state machine, window by window."""
    out, is_open, hots, calms = [], False, 0, 0
    for i, ((s, v), band) in enumerate(zip(xs, bands)):
        off = band is not None and not band[0] <= v <= band[1]
        hot = s is not None and (s >= high or (s >= low and off))
        calm = s is not None and s < low and not off
        hots, calms = (hots + 1 if hot else 0), (calms + 1 if calm else 0)
        if not is_open and hots >= n_open:
            is_open = True
            out.append({"from": i, "n": 0, "peak": -np.inf, "off": 0, "closed": False})
        elif is_open and calms >= n_close:
            is_open, out[-1]["closed"] = False, True
        if is_open:
            e = out[-1]
            e["n"], e["to"], e["off"], e["peak"] = e["n"] + 1, i, e["off"] + off, max(e["peak"], s if s is not None else -np.inf)
    return [(j + 1, AT(10 * e["from"]), AT(10 * e["to"] + 30), e["n"], e["peak"], e["off"], e["closed"]) for j, e in enumerate(out)]


@pytest.mark.parametrize("n_open,n_close", [(1, 1), (3, 5), (2, 40)])
def test_episodes_over_many_chunks(spark, n_open, n_close):
    """Runs are longer than a chunk in one series; another has a third of the rows; some scores are null."""
    rng = np.random.default_rng(n_open)
    walk = lambda n: (3 + np.cumsum(rng.normal(0, 0.5, n)) % 4).round(2).tolist()
    scores = {"a": walk(200), "b": [5.0] * 60 + [0.0] * 60, "c": walk(90), "d": [9.0, None, 9.0, 9.0, 9.0], "e": [0.0] * 4}
    series = {k: [(s, float(rng.normal(50, 10))) for s in xs] for k, xs in scores.items()}
    steps = 400
    lower, upper = rng.normal(42, 2, steps), rng.normal(58, 2, steps)
    known = [i for i in range(steps) if i % 7 and not 90 <= i < 130]  # an irregular forecast
    forecast = spark.createDataFrame([(AT(5 * i), float(lower[i]), float(upper[i])) for i in known], "timestamp timestamp, forecast_lower double, forecast_upper double")
    got = alerts.alert_episodes(windows_of(spark, series), ["entity_id"], "score", 5.0, 4.0, n_open, n_close, forecast)
    found = {}
    for r in got.orderBy("entity_id", "episode").collect():
        found.setdefault(r.entity_id, []).append(tuple(r)[1:])
    for name, xs in series.items():
        bands = []
        for i in range(len(xs)):
            inside = [j for j in known if 10 * i <= 5 * j <= 10 * i + 30]
            bands.append((lower[inside].mean(), upper[inside].mean()) if inside else None)
        assert found.get(name, []) == by_hand(xs, bands, 5.0, 4.0, n_open, n_close)


def test_band_by_key(spark):
    df = windows_of(spark, {"a": [(1.0, 50.0)] * 3, "b": [(1.0, 50.0)]})
    forecast = spark.createDataFrame([("a", AT(0), 1.0, 9.0), ("a", AT(30), 3.0, 11.0), ("a", AT(31), None, 5.0)], "entity_id string, timestamp timestamp, forecast_lower double, forecast_upper double")
    got = alerts.forecast_band(df, forecast, ["entity_id"]).orderBy("entity_id", "window_start").collect()
    assert [(r.n_forecast, r.band_lower, r.band_upper) for r in got] == [(2, 2.0, 10.0), (1, 3.0, 11.0), (1, 3.0, 11.0), (0, None, None)]


def test_without_forecast_or_rows(spark):
    df = windows_of(spark, {"a": [(9.0, 1.0)] * 3})
    assert [r.n_windows for r in alerts.alert_episodes(df, ["entity_id"], "score", 5, 4).collect()] == [1]
    assert alerts.alert_episodes(df.where("false"), ["entity_id"], "score", 5, 4).collect() == []
    with pytest.raises(ValueError):
        alerts.alert_episodes(df, ["entity_id"], "score", 4, 5)
    with pytest.raises(ValueError):
        alerts.alert_episodes(df, ["entity_id"], "score", 5, 4, 0)


def test_states_keep_every_window(spark):
    df = windows_of(spark, {"a": [(9.0, 1.0), (9.0, 1.0), (4.5, 1.0), (0.0, 1.0), (0.0, 1.0), (9.0, 1.0)]})
    got = alerts.episode_states(df, ["entity_id"], ["window_start"], F.col("score") >= 5, F.col("score") < 4, 2, 2).orderBy("rn").collect()
    assert [(r.is_open, r.episode) for r in got] == [(False, 0), (True, 1), (True, 1), (True, 1), (False, 1), (False, 1)]
