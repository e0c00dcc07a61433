import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.config import PipelineConfig
from sensorloom.operators import forecast
from sensorloom.plans import catalog

from conftest import START


def hours(make, **series):
    return make(series, {k: [60 * i for i in range(len(v))] for k, v in series.items()})


def sine(n, phase=0.0, level=90.0):
    return [level + 3 * math.sin(2 * math.pi * (i + phase) / 24) for i in range(n)]


def test_hourly_mean(make):
    got = forecast.hourly_mean(make({"a": [1, 2, None, 6], "b": [3, 4]}, {"a": [0, 59, 61, 130], "b": [5, 6]}))
    assert [(r.hour, r.hourly_mean) for r in got.orderBy("hour").collect()] == [
        (START, 2.5),
        (START + dt.timedelta(hours=2), 6.0),
    ]
    assert forecast.hourly_mean(make({"a": [1], "b": [3]}), ["entity_id"]).count() == 2


def test_future_grid(make):
    grid = forecast.future_grid(make({"a": [1, 2], "b": [3, 4]}, {"a": [0, 1], "b": [1, 2.5]}), 3).orderBy("timestamp").collect()
    at = [round((r.timestamp - START).total_seconds() / 60, 1) for r in grid]
    assert at == [0, 1, 2.5, 3.5, 4.5, 5.5]
    assert [r.step for r in grid] == [None, None, None, 1, 2, 3]
    per_entity = forecast.future_grid(make({"a": [1, 2], "b": [3]}), 3, ["entity_id"])
    assert {r.entity_id: r.n for r in per_entity.groupBy("entity_id").agg(F.count("*").alias("n")).collect()} == {"a": 5, "b": 4}


def test_moments_match_the_design_matrix(make):
    rng = np.random.default_rng(11)
    readings = hours(make, a=rng.normal(50, 5, 40)).repartition(3)
    got = {(r.i, r.j): r.moment for r in forecast.moments(readings).collect()}
    width = len(forecast.basis_names())
    assert width == 41 and len(got) == 42 * 43 // 2
    ends = readings.agg(F.min("time"), F.max("time")).first()
    wide = readings.select(*[c.alias(f"x{i}") for i, c in enumerate(forecast.basis(F.col("time"), F.lit(ends[0]), F.lit(ends[1])))], "value")
    x = wide.toPandas().to_numpy()
    gram = x.T @ x / len(x)
    for (i, j), v in got.items():
        assert v == pytest.approx(gram[i, j], rel=1e-9, abs=1e-9)


def test_seasonal_recovers_a_daily_wave(make):
    readings = hours(make, a=sine(24 * 21))
    model = forecast.train_seasonal(readings)
    table = forecast.seasonal_forecast(forecast.future_grid(readings, 24 * 60), model).where("step is not null").toPandas()
    start = 24 * 21 - 1
    want = 90 + 3 * np.sin(2 * np.pi * (start + table["step"] / 60) / 24)
    assert np.abs(table["seasonal_point"] - want).max() < 0.1
    assert (table["forecast_lower"] <= table["seasonal_point"]).all()


def test_interval_covers_the_noise(make):
    rng = np.random.default_rng(12)
    readings = hours(make, a=np.array(sine(24 * 28)) + rng.normal(0, 1, 24 * 28))
    model = forecast.train_seasonal(readings)
    assert model.first().sigma == pytest.approx(1, abs=0.15)
    grid = readings.select(F.col("time").alias("timestamp"), "value")
    inside = forecast.seasonal_forecast(grid, model, width=0.9).agg(
        F.avg(F.col("value").between(F.col("forecast_lower"), F.col("forecast_upper")).cast("int"))
    )
    assert inside.first()[0] == pytest.approx(0.9, abs=0.04)


def test_models_per_entity(make):
    readings = hours(make, a=sine(24 * 10), b=sine(24 * 10, 12, 40.0), short=[1.0])
    by = ["entity_id"]
    table = forecast.forecast_ensemble(readings, 60, by).where("step = 60")
    got = {r.entity_id: r.seasonal_point for r in table.collect()}
    assert set(got) == {"a", "b"}
    assert got["a"] == pytest.approx(90, abs=1.5) and got["b"] == pytest.approx(40, abs=1.5)


def test_too_little_data(make):
    one = make({"a": [1.0]})
    assert forecast.train_seasonal(one).count() == 0
    assert forecast.train_arima(hours(make, a=[1.0] * 9)).count() == 0
    table = forecast.forecast_ensemble(hours(make, a=[1.0, 2.0, 1.0]), 5).where("step is not null").toPandas()
    assert len(table) == 5 and np.allclose(table["ensemble_point"], table["seasonal_point"])


def test_arima_finds_an_autoregression(make):
    rng = np.random.default_rng(13)
    y = np.zeros(800)
    for t in range(1, 800):
        y[t] = 0.8 * y[t - 1] + rng.normal()
    best = forecast.train_arima(hours(make, a=y + 50)).first()
    assert best.d == 0 and best.p >= 1 and best.n_hours == 800
    fit = forecast.hannan_rissanen(y + 50, (1, 0, 0), 168)
    assert fit[1][1] == pytest.approx(0.8, abs=0.06)
    assert fit[2][0] == pytest.approx(50 + 0.8 * y[-1], abs=0.5)
    assert fit[2][-1] == pytest.approx((y + 50).mean(), abs=0.5)


def test_arima_integrates_a_random_walk(make):
    walk = np.cumsum(np.random.default_rng(14).normal(0, 1, 600))
    aic, _, ahead = forecast.hannan_rissanen(walk, (0, 1, 0), 5)
    assert np.allclose(ahead, walk[-1])
    assert aic < forecast.hannan_rissanen(walk, (0, 0, 0), 5)[0]


def test_all_orders_are_tried(make):
    fits = forecast.arima_orders(hours(make, a=sine(100)))
    assert fits.count() == 18
    assert fits.where("size(values) not in (0, 168)").count() == 0


def test_step_hold_blend(spark):
    minutes = spark.createDataFrame([(None, 1.0), (1, 10.0), (60, 10.0), (61, 10.0), (500, 10.0)], "step int, seasonal_point double")
    hourly = spark.createDataFrame([(0, 0.0), (1, 100.0)], "h int, hourly_value double")
    got = {r.step: r.ensemble_point for r in forecast.step_hold_blend(minutes, hourly).collect()}
    assert got == {None: 1.0, 1: 6.0, 60: 6.0, 61: 46.0, 500: 46.0}
    empty = forecast.step_hold_blend(minutes, hourly.where("false")).collect()
    assert all(r.ensemble_point == r.seasonal_point for r in empty)


def test_metrics_and_alignment(spark, make):
    actual = make({"a": [10.0, 0.0, 20.0]}, {"a": [1, 2, 9]})
    rows = [(START + dt.timedelta(minutes=m), s, p) for m, s, p in [(0, None, 7.0), (1, 1, 11.0), (2, 2, 3.0), (3, 3, 5.0)]]
    table = spark.createDataFrame(rows, "timestamp timestamp, step int, forecast_point double")
    m = forecast.forecast_metrics(forecast.aligned(actual, table)).first()
    assert (m.n, m.mae, m.rmse, m.mape) == (2, 2.0, pytest.approx(math.sqrt(5)), pytest.approx(10.0))
    m = forecast.forecast_metrics(forecast.aligned(actual, table, "position")).first()
    assert (m.n, m.mae) == (3, pytest.approx((3 + 11 + 17) / 3))
    with pytest.raises(ValueError):
        forecast.aligned(actual, table, "other")


def test_a_short_series_takes_a_quarter_for_the_first_regression():
    rng = np.random.default_rng(3)
    y = 5 + np.cumsum(rng.normal(0, 0.1, 30))
    assert forecast.hannan_rissanen(y, (1, 0, 1), 3) is not None
    shorter = forecast.hannan_rissanen(y, (1, 0, 1), 3, long_order=3)
    longer = forecast.hannan_rissanen(y, (1, 0, 1), 3, long_order=50)
    assert shorter[0] != longer[0] and longer[0] == forecast.hannan_rissanen(y, (1, 0, 1), 3, long_order=7)[0]


def test_forecast_head(spark):
    rows = [("a", i) for i in range(100, 0, -1)] + [("b", i) for i in range(3)]
    table = spark.createDataFrame(rows, "entity_id string, timestamp bigint").repartition(4)
    got = forecast.forecast_head(table, 5, ["entity_id"]).collect()
    assert sorted(map(tuple, got)) == [("a", i) for i in range(1, 6)] + [("b", i) for i in range(3)]
    assert forecast.forecast_head(table, 2).count() == 2


def test_history_is_not_shuffled_to_one_place(spark):
    """Rows without a step keep their partitions when the hours are joined."""
    minutes = spark.range(2000).selectExpr("timestamp_seconds(id * 60) as timestamp", "case when id >= 1990 then cast(id - 1989 as int) end as step", "1.0d as seasonal_point")
    hourly = spark.createDataFrame([(0, 3.0)], "h int, hourly_value double")
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        blended = forecast.step_hold_blend(minutes.repartition(4), hourly)
        sizes = blended.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 1000 and sum(r["count"] for r in sizes) == 2000
        assert blended.where("step = 1").first().ensemble_point == pytest.approx(0.6 + 0.4 * 3)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_moments_of_many_interleaved_series(make):
    rng = np.random.default_rng(8)
    readings = make({f"e{i}": rng.normal(5, 1, 40) for i in range(30)}).repartition(5)
    got = forecast.moments(readings, ["entity_id"])
    width = len(forecast.basis_names())
    square = {r.entity_id: r.moment for r in got.where(F.col("j") == width).where(F.col("i") == width).collect()}
    want = {r.entity_id: r.m for r in readings.groupBy("entity_id").agg(F.avg(F.col("value") * F.col("value")).alias("m")).collect()}
    assert square == pytest.approx(want)


def test_each_series_is_forecast_a_week_like_a_table_of_its_own(make):
    """Every step of the registered horizon, ARIMA hours 1 to 168 and beyond the first day too."""
    rng = np.random.default_rng(15)
    walk = {"a": np.array(sine(240)) + np.cumsum(rng.normal(0, 0.3, 240)), "b": np.array(sine(240, 12, 40.0)) + rng.normal(0, 1, 240)}
    steps = catalog.ENTITY_STEPS
    assert steps == PipelineConfig().forecast_steps
    both = forecast.forecast_ensemble(hours(make, **walk), steps, ["entity_id"]).where("step is not null").toPandas()
    for name, values in walk.items():
        alone = forecast.forecast_ensemble(hours(make, **{name: values}), steps).where("step is not null").toPandas().sort_values("step")
        mine = both[both["entity_id"] == name].sort_values("step")
        assert mine["step"].tolist() == alone["step"].tolist() == list(range(1, 7 * 24 * 60 + 1))
        for c in ("seasonal_point", "ensemble_point", "forecast_lower", "forecast_upper"):
            assert np.allclose(mine[c], alone[c], atol=1e-6)
        assert not np.allclose(alone["ensemble_point"], alone["seasonal_point"])


def wandering(n_series, known, ahead, size, seed):
    """Series whose slope changes a little every hour, with noise 1 around them."""
    rng = np.random.default_rng(seed)
    per_hour = size * math.sqrt(forecast.HINGES / forecast.HINGE_RANGE / known) / known
    slope = np.cumsum(rng.normal(0, per_hour, (n_series, known + ahead)), axis=1)
    return 200 + np.cumsum(slope, axis=1) + rng.normal(0, 1, slope.shape)


def test_widening_interval_covers_planted_trends(make):
    known, ahead = 24 * 28, 24 * 7
    values = wandering(60, known, ahead, 40.0, 21)
    readings = hours(make, **{f"e{i}": v[:known] for i, v in enumerate(values)})
    by = ["entity_id"]
    model = forecast.train_seasonal(readings, by).cache()
    assert model.agg(F.expr("median(drift)")).first()[0] == pytest.approx(40, rel=0.4)
    actual = hours(make, **{f"e{i}": v for i, v in enumerate(values)}).where(F.col("time") > F.lit(START + dt.timedelta(hours=known - 1)))
    grid = actual.select(*by, F.col("time").alias("timestamp"), "value")

    def covered(widen):
        table = forecast.seasonal_forecast(grid, model, by, 0.9, widen)
        return table.agg(F.avg(F.col("value").between(F.col("forecast_lower"), F.col("forecast_upper")).cast("int"))).first()[0]

    assert covered(True) == pytest.approx(0.9, abs=0.07)
    assert covered(False) < 0.5


def test_widening_interval_keeps_the_history_and_grows(make):
    readings = hours(make, a=wandering(1, 24 * 14, 0, 20.0, 22)[0])
    model = forecast.train_seasonal(readings)
    grid = forecast.future_grid(readings, 2 * 24 * 60)
    narrow, wide = (forecast.seasonal_forecast(grid, model, widen=w).toPandas().sort_values("timestamp") for w in (False, True))
    past = wide["step"].isna()
    half = (wide["forecast_upper"] - wide["forecast_lower"])[~past].to_numpy()
    assert np.array_equal(wide["forecast_upper"][past], narrow["forecast_upper"][narrow["step"].isna()])
    assert (np.diff(half) > 0).all() and np.allclose(wide["seasonal_point"], narrow["seasonal_point"])
    with pytest.raises(ValueError):
        forecast.seasonal_forecast(grid, model.drop("drift"), widen=True)


def test_missed_trend_is_that_of_a_line_through_the_last_stretch(spark):
    """The closed form against lines fitted to a change of slope at each place."""
    ahead, rest, fine = 0.3, 1 - forecast.HINGE_RANGE, 2000
    x = (np.arange(fine) + 0.5) / fine * rest
    missed = []
    for at in x[::20]:
        line = np.polyfit(x, np.maximum(x - at, 0), 1)
        missed.append((rest + ahead - at - np.polyval(line, rest + ahead)) ** 2)
    want = 4 * forecast.HINGES / forecast.HINGE_RANGE * (np.mean(missed) * rest + ahead**3 / 3)
    got = spark.range(1).select(forecast.trend_variance(F.lit(ahead), F.lit(2.0)), forecast.trend_variance(F.lit(-0.1), F.lit(2.0))).first()
    assert got[0] == pytest.approx(want, rel=1e-2) and got[1] == 0


def test_arima_by_two_keys(make):
    readings = hours(make, a=sine(60), b=sine(60, 5)).withColumn("site", F.lit(1))
    fits = forecast.arima_orders(readings, ["entity_id", "site"], 3)
    assert fits.count() == 36 and fits.select("entity_id", "site").distinct().count() == 2
