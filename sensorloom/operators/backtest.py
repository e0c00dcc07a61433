"""Rolling-origin backtest of hourly forecasts, and the choice of a model for each series.

Readings are reduced to one value per series and clock hour first, so all that is copied for the
cutoffs, and every group, is bounded by the calendar. The origins are hours of one calendar for all
series: no model sees an hour of any series that lies after its cutoff. All cutoffs are fitted in one
plan, as a key beside those of the series; the trees are one Spark ML forest a cutoff over all series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.operators import forecast
from sensorloom.session import freeze

#: In the order in which equal errors are decided.
MODELS = ("seasonal", "arima", "blend", "day_before", "week_before", "mean", "trees")
DEFAULT = "blend"
HORIZON = 24
ORIGINS = 3
STRIDE = 24
TREES, DEPTH, SEED = 20, 6, 7
DAY, WEEK = 24, 7 * 24


def hour_number(hour: str) -> Column:
    """Hours since 1970 of a timestamp column."""
    return F.expr(f"unix_seconds({hour}) div 3600")


def hour_at(number: int | Column) -> Column:
    return F.timestamp_seconds((F.lit(number) if isinstance(number, int) else number) * 3600)


def last_hour(hours: DataFrame) -> int | None:
    return hours.agg(F.max(hour_number("hour"))).first()[0]


def cutoffs(hours: DataFrame, horizon: int = HORIZON, count: int = ORIGINS, stride: int = STRIDE) -> list[int]:
    """First hours to forecast (since 1970), latest first; the last horizon ends with the last hour of the table."""
    last = last_hour(hours)
    return [] if last is None else [last - (horizon - 1 + k * stride) for k in range(count)]


def fan_out(hours: DataFrame, origins: Sequence[int], horizon: int = HORIZON) -> DataFrame:
    """Hours once for each origin, up to its horizon: adds ``origin`` and ``h`` (0 at the origin, below it the past)."""
    copies = hours.withColumn("_o", F.explode(F.array(*[F.lit(o) for o in origins]).cast("array<bigint>")))
    placed = copies.withColumns({"origin": hour_at(F.col("_o")), "h": (hour_number("hour") - F.col("_o")).cast("int")})
    return placed.drop("_o").where(F.col("h") < horizon)


def asked_hours(known: DataFrame, by: Sequence[str], horizon: int = HORIZON) -> DataFrame:
    """(by, origin, h, hour) to forecast, for all series with a known hour."""
    series = known.select(*by, "origin").distinct()
    ahead = series.withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))))
    return ahead.withColumn("hour", F.col("origin") + F.make_dt_interval(hours=F.col("h")))


# ---------------------------------------------------------------- candidates: (by, origin, h, predicted)


def last_known(known: DataFrame, asked: DataFrame, by: Sequence[str], period: int) -> DataFrame:
    """The last known value of the same hour of the day or week; the mean where there is none."""
    keys = [*by, "origin"]
    slot = F.pmod(hour_number("hour"), F.lit(period)).alias("slot")
    profile = known.groupBy(*keys, slot).agg(F.max_by("hourly_mean", "hour").alias("last"))
    wanted = mean_known(known, asked, by, "mean").withColumn("slot", F.pmod(hour_number("hour"), F.lit(period)))
    return wanted.join(profile, [*keys, "slot"], "left").select(*keys, "h", F.coalesce("last", "mean").alias("predicted"))


def mean_known(known: DataFrame, asked: DataFrame, by: Sequence[str], name: str = "predicted") -> DataFrame:
    keys = [*by, "origin"]
    return asked.join(known.groupBy(*keys).agg(F.avg("hourly_mean").alias(name)), keys)


def _as_readings(known: DataFrame, keys: Sequence[str]) -> DataFrame:
    return known.select(*keys, F.col("hour").alias("time"), F.col("hourly_mean").alias("value"))


def seasonal(known: DataFrame, asked: DataFrame, by: Sequence[str]) -> DataFrame:
    keys = [*by, "origin"]
    model = freeze(forecast.train_seasonal(_as_readings(known, keys), keys), "backtest_seasonal")
    table = forecast.seasonal_forecast(asked.withColumn("timestamp", F.col("hour")), model, keys)
    return table.select(*keys, "h", F.col("seasonal_point").alias("predicted"))


def arima(known: DataFrame, by: Sequence[str], horizon: int = HORIZON) -> DataFrame:
    keys = [*by, "origin"]
    best = forecast.train_arima(_as_readings(known, keys), keys, horizon)
    return best.select(*keys, F.posexplode("values").alias("h", "predicted"))


def blend(seasonal_part: DataFrame, arima_part: DataFrame, by: Sequence[str]) -> DataFrame:
    keys = [*by, "origin", "h"]
    both = seasonal_part.join(arima_part.withColumnRenamed("predicted", "level"), keys)
    mixed = F.lit(forecast.SEASONAL_WEIGHT) * F.col("predicted") + F.lit(1 - forecast.SEASONAL_WEIGHT) * F.col("level")
    return both.select(*keys, mixed.alias("predicted"))


def lag_features(known: DataFrame, asked: DataFrame, by: Sequence[str], horizon: int = HORIZON) -> tuple[DataFrame, list[str]]:
    """Rows of both tables with values of whole days before, at least a horizon back, so none is unknown.

    Values are relative to mean and deviation of the series before the origin (``mean``, ``std``); lags
    without a reading take the mean. Frames run over hours, not rows, within one series and origin.
    """
    keys = [*by, "origin"]
    far = -(-horizon // DAY) * DAY
    columns = [*keys, "h", "hour"]
    rows = known.select(*columns, "hourly_mean").unionByName(asked.select(*columns, F.lit(None).cast("double").alias("hourly_mean")))
    level = known.groupBy(*keys).agg(F.avg("hourly_mean").alias("mean"), F.stddev_pop("hourly_mean").alias("std"))
    rows = rows.join(level, keys).withColumn("std", F.when(F.col("std") > 0, F.col("std")).otherwise(1.0))
    rows = rows.withColumns({"y": (F.col("hourly_mean") - F.col("mean")) / F.col("std"), "at": hour_number("hour")})
    order = Window.partitionBy(*keys).orderBy("at")
    made = {f"lag_{far + d}": F.max("y").over(order.rangeBetween(-far - d, -far - d)) for d in (0, DAY, WEEK - DAY)}
    made |= {f"mean_{n}": F.avg("y").over(order.rangeBetween(-far - n + 1, -far)) for n in (6, DAY, WEEK)}
    made["deviation"] = F.stddev_pop("y").over(order.rangeBetween(-far - DAY + 1, -far))
    for label, period in (("day", DAY), ("week", WEEK)):
        angle = F.pmod("at", F.lit(period)) * F.lit(2 * math.pi / period)
        made |= {f"{label}_sin": F.sin(angle), f"{label}_cos": F.cos(angle)}
    return rows.withColumns(made).fillna(0.0, list(made)), list(made)


def trees(known: DataFrame, asked: DataFrame, by: Sequence[str], origins: Sequence[int], horizon: int = HORIZON) -> DataFrame:
    """One forest of regression trees per origin, over the lag features of all series."""
    keys = [*by, "origin"]
    rows, names = lag_features(known, asked, by, horizon)
    rows = freeze(VectorAssembler(inputCols=names, outputCol="features").transform(rows).select(*keys, "h", "y", "mean", "std", "features"), "lags")
    forest = RandomForestRegressor(labelCol="y", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    told = None
    for o in origins:
        own = rows.where(F.col("origin") == hour_at(o))
        learn = own.where("h < 0 and y is not null")
        if learn.isEmpty():
            continue
        found = forest.fit(learn).transform(own.where("h >= 0"))
        found = found.select(*keys, "h", (F.col("prediction") * F.col("std") + F.col("mean")).alias("predicted"))
        told = found if told is None else told.unionByName(found)
    return rows.where("false").select(*keys, "h", F.col("y").alias("predicted")) if told is None else told


def predictions(
    known: DataFrame, origins: Sequence[int], by: Sequence[str] = (), models: Sequence[str] = MODELS, horizon: int = HORIZON
) -> DataFrame:
    """(by, origin, h, model, predicted) of the asked models; ``known`` holds (by, origin, h, hour, hourly_mean) before the origins.

    A model that a series is too short for has no row there.
    """
    if unknown := set(models) - set(MODELS):
        raise ValueError(f"unknown models: {', '.join(sorted(unknown))}")
    asked = asked_hours(known, by, horizon)
    keys = [*by, "origin", "h"]
    parts = {}
    if {"seasonal", "blend"} & set(models):
        parts["seasonal"] = freeze(seasonal(known, asked, by).select(*keys, "predicted"), "backtest_seasonal_points")
    if {"arima", "blend"} & set(models):
        parts["arima"] = freeze(arima(known, by, horizon).select(*keys, "predicted"), "backtest_arima_points")
    if "blend" in models:
        parts["blend"] = blend(parts["seasonal"], parts["arima"], by)
    if "day_before" in models:
        parts["day_before"] = last_known(known, asked, by, DAY)
    if "week_before" in models:
        parts["week_before"] = last_known(known, asked, by, WEEK)
    if "mean" in models:
        parts["mean"] = mean_known(known, asked, by)
    if "trees" in models:
        parts["trees"] = trees(known, asked, by, origins, horizon)
    out = None
    for name in models:
        part = parts[name].select(*keys, F.lit(name).alias("model"), "predicted")
        out = part if out is None else out.unionByName(part)
    return out


def backtest(
    readings: DataFrame,
    by: Sequence[str] = (),
    models: Sequence[str] = MODELS,
    horizon: int = HORIZON,
    count: int = ORIGINS,
    stride: int = STRIDE,
) -> DataFrame:
    """(by, origin, h, model, actual, forecast) for every hour with a reading within the horizon of an origin.

    Readings without a time or a number take no part; an empty table gives an empty one. A series without an
    hour before an origin, or within its horizon, has no row for it.
    """
    hours = freeze(forecast.hourly_mean(readings, by), "hours")
    origins = cutoffs(hours, horizon, count, stride)
    copies = freeze(fan_out(hours, origins, horizon), "origins")
    told = predictions(copies.where("h < 0"), origins, by, models, horizon)
    actual = copies.where("h >= 0").select(*by, "origin", "h", F.col("hourly_mean").alias("actual"))
    pairs = told.join(actual, [*by, "origin", "h"])
    return pairs.select(*by, "origin", "h", "model", "actual", F.col("predicted").alias("forecast"))


def errors(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, model, n, mae, rmse, mape) over the pairs of a backtest."""
    return forecast.forecast_metrics(pairs, [*by, "model"])


def choose(errors: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, model, rmse, mae, n, models): the model with the smallest root mean square error.

    Only models that forecast as many hours as the best covered one count; equal errors go by the order
    of ``MODELS``. ``models`` is the number that was compared.
    """
    place = F.array_position(F.array(*[F.lit(m) for m in MODELS]), F.col("model"))
    # Errors that differ by rounding alone are equal.
    rank = F.struct((-F.col("n")).alias("n"), F.round("rmse", 9).alias("rmse"), place.alias("place"))
    best = errors.groupBy(*by).agg(
        F.min_by(F.struct("model", "rmse", "mae", "n"), rank).alias("best"), F.count(F.lit(1)).alias("models")
    )
    return best.where("best is not null").select(*by, "best.*", "models")


def forecast_chosen(
    readings: DataFrame, choice: DataFrame, by: Sequence[str] = (), horizon: int = HORIZON, default: str = DEFAULT
) -> DataFrame:
    """(by, hour, h, model, predicted): the hours after the last of all readings, for each series by its chosen model.

    Series without a choice take the ``default``. A series that its model cannot serve, since it is too short,
    has the mean of its known hours. A model is trained on the series that chose it, the trees on all.
    """
    hours = freeze(forecast.hourly_mean(readings, by), "hours")
    last = last_hour(hours)
    origins = [] if last is None else [last + 1]
    known = fan_out(hours, origins, horizon)
    chosen = choice.select(*by, "model")
    if by:
        known = known.join(chosen, list(by), "left")
    else:
        row = chosen.first()
        known = known.withColumn("model", F.lit(row.model if row else None).cast("string"))
    known = freeze(known.fillna({"model": default}), "known")
    keys = [*by, "origin", "h"]
    asked = asked_hours(known, [*by, "model"], horizon)
    told = None
    for name in sorted(r.model for r in known.select("model").distinct().collect()):
        learn = known if name == "trees" else known.where(F.col("model") == name)
        part = predictions(learn.drop("model"), origins, by, [name], horizon)
        told = part if told is None else told.unionByName(part)
    if told is None:
        return asked.select(*by, "hour", "h", "model", F.lit(None).cast("double").alias("predicted"))
    served = mean_known(known, asked, [*by, "model"], "mean").join(told, [*keys, "model"], "left")
    return served.select(*by, "hour", "h", "model", F.coalesce("predicted", "mean").alias("predicted"))
