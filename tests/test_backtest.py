import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import backtest, forecast

from conftest import START

BY = ["entity_id"]


def hourly(make, **series):
    return make(series, {k: [60 * i for i in range(len(v))] for k, v in series.items()})


def daily(n, level=50.0, size=10.0, noise=0.0, seed=1):
    return level + size * np.sin(2 * np.pi * np.arange(n) / 24) + np.random.default_rng(seed).normal(0, 1, n) * noise


def steps(n, seed=2):
    """A pattern of the week that waves of a day and 3 of a week cannot follow."""
    week = np.random.default_rng(seed).normal(0, 20, 168)
    return 100 + week[np.arange(n) % 168]


def pairs_of(table):
    return {(r.entity_id, r.origin, r.h, r.model): (r.actual, r.forecast) for r in table.collect()}


def test_lookups_like_plain_loops(make):
    rng = np.random.default_rng(3)
    at = {k: sorted(rng.choice(24 * 9, 150, replace=False).tolist()) for k in "ab"}
    values = {k: rng.normal(50, 5, 150).tolist() for k in "ab"}
    readings = make(values, {k: [60 * i for i in v] for k, v in at.items()})
    models = ("day_before", "week_before", "mean")
    got = pairs_of(backtest.backtest(readings, BY, models, horizon=12, count=2, stride=30))
    last = max(max(v) for v in at.values())
    want = {}
    for origin in (last - 11, last - 41):
        for k in "ab":
            known = {i: v for i, v in zip(at[k], values[k]) if i < origin}
            mean = sum(known.values()) / len(known)
            for i, v in zip(at[k], values[k]):
                if not origin <= i < origin + 12:
                    continue
                key = (k, START + dt.timedelta(hours=origin), i - origin)
                for model, period in (("day_before", 24), ("week_before", 168)):
                    same = [j for j in known if j % period == i % period]
                    want[*key, model] = (v, known[max(same)] if same else mean)
                want[*key, "mean"] = (v, mean)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_fitted_models_equal_a_run_on_the_hours_before_each_origin(make):
    readings = hourly(make, a=daily(24 * 8, noise=1.0), b=daily(24 * 8, 80.0, 3.0, 2.0, 5))
    got = pairs_of(backtest.backtest(readings, BY, ("seasonal", "arima", "blend"), count=2))
    for k in range(2):
        cut = 24 * 8 - 24 * (k + 1)
        before = readings.where(F.col("time") < F.lit(START + dt.timedelta(hours=cut)))
        alone = forecast.forecast_ensemble(before, 24 * 60 + 60, BY).where("step % 60 = 0").collect()
        levels = {(r.entity_id, h): v for r in forecast.train_arima(before, BY, 24).collect() for h, v in enumerate(r["values"])}
        for r in alone:
            h = r.step // 60 - 1
            if h >= 24:
                continue
            key = (r.entity_id, START + dt.timedelta(hours=cut), h)
            seasonal, level = got[*key, "seasonal"][1], got[*key, "arima"][1]
            assert seasonal == pytest.approx(r.seasonal_point, abs=1e-6)
            assert level == pytest.approx(levels[r.entity_id, h], abs=1e-6)
            assert got[*key, "blend"][1] == pytest.approx(0.6 * seasonal + 0.4 * level)


def test_no_model_sees_what_lies_behind_an_origin(make):
    values = daily(24 * 12, noise=1.0)
    changed = values.copy()
    changed[-24:] += 1000
    one, two = (pairs_of(backtest.backtest(hourly(make, a=v, b=daily(24 * 12)), BY, count=1)) for v in (values, changed))
    assert one.keys() == two.keys() and {k[3] for k in one} == set(backtest.MODELS)
    for k in one:
        assert one[k][1] == pytest.approx(two[k][1], abs=1e-6)


def test_the_right_model_is_chosen(make):
    n = 24 * 35
    rng = np.random.default_rng(9)
    walk = 50 + np.cumsum(rng.normal(0, 2, n))
    readings = hourly(make, wave=daily(n, noise=1.0), weekly=steps(n), walk=walk)
    table = backtest.backtest(readings, BY)
    errors = backtest.errors(table, BY).cache()
    chosen = {r.entity_id: r for r in backtest.choose(errors, BY).collect()}
    assert chosen["wave"].model in ("seasonal", "blend", "trees") and chosen["wave"].rmse < 1.5
    assert chosen["weekly"].model == "week_before" and chosen["weekly"].rmse < 1e-6
    assert chosen["walk"].models == len(backtest.MODELS)
    least = {}
    for r in errors.collect():
        least[r.entity_id] = min(least.get(r.entity_id, math.inf), r.rmse)
    assert {k: r.rmse for k, r in chosen.items()} == pytest.approx(least)

    ahead = backtest.forecast_chosen(readings, backtest.choose(errors, BY), BY).toPandas()
    assert len(ahead) == 3 * 24 and not ahead["predicted"].isna().any()
    assert ahead.groupby("entity_id")["model"].first().to_dict() == {k: r.model for k, r in chosen.items()}
    weekly = ahead[ahead["entity_id"] == "weekly"].sort_values("h")
    assert np.allclose(weekly["predicted"], steps(n + 24)[-24:])
    assert weekly["hour"].iloc[0].to_pydatetime() == START + dt.timedelta(hours=n)


def test_lags_are_hours_and_reach_a_horizon_back(make):
    at = [0, 1, 2, 24, 30, 54]
    hours = forecast.hourly_mean(make({"a": [1, 2, 3, 4, 5, 6]}, {"a": [60 * i for i in at]}), BY)
    copies = backtest.fan_out(hours, [backtest.last_hour(hours)], 24)
    known = copies.where("h < 0")
    rows, names = backtest.lag_features(known, backtest.asked_hours(known, BY), BY)
    got = {r.h: r for r in rows.collect()}
    y = (np.array([1, 2, 3, 4, 5]) - 3) / math.sqrt(2)
    assert set(got) == {i - 54 for i in at[:5]} | set(range(24)) and "lag_24" in names
    # Hour 54 (h = 0): one day before is hour 30; two days before is hour 6, which has no reading.
    assert got[0].lag_24 == pytest.approx(y[4]) and got[0].lag_48 == 0
    assert got[24 - 54].lag_24 == pytest.approx(y[0])
    assert got[0].mean_24 == pytest.approx(np.mean([y[3], y[4]]))
    assert got[0].y is None


def test_choice_prefers_whole_coverage_and_breaks_ties_by_order(spark):
    rows = [("a", "arima", 5, 1.0, 1.0, 1.0), ("a", "mean", 9, 2.0, 2.0, 1.0), ("a", "day_before", 9, 2.0, 2.0, 1.0)]
    table = spark.createDataFrame(rows, "entity_id string, model string, n long, rmse double, mae double, mape double")
    best = backtest.choose(table, BY).first()
    assert (best.model, best.n, best.models) == ("day_before", 9, 3)
    assert backtest.choose(table).first().model == "day_before"


def test_empty_and_short_tables(make):
    none = make({"a": [None, None]})
    table = backtest.backtest(none, BY)
    assert table.columns == [*BY, "origin", "h", "model", "actual", "forecast"] and table.count() == 0
    choice = backtest.choose(backtest.errors(table, BY), BY)
    assert choice.count() == 0 and backtest.forecast_chosen(none, choice, BY).count() == 0
    # One known hour: no fitted model serves it, nor is there an hour before an origin.
    short = backtest.forecast_chosen(make({"a": [7.0]}), choice, BY).toPandas()
    assert len(short) == 24 and (short["predicted"] == 7.0).all() and (short["model"] == backtest.DEFAULT).all()
    pooled = backtest.forecast_chosen(hourly(make, a=daily(100)), backtest.choose(backtest.errors(table)))
    assert pooled.count() == 24
    with pytest.raises(ValueError):
        backtest.backtest(hourly(make, a=daily(100)), BY, ("seasonal", "other"))
