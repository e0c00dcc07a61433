"""Seasonal and ARIMA forecasts, their blend and its errors.

A model is fitted per value of the ``by`` columns, or once over all series pooled
(``by=[]``). The seasonal model is a ridge regression: Spark reduces the readings to one
42 x 42 moment matrix per model and only that matrix is solved. The ARIMA model sees one value
per clock hour, so its groups are bounded by the calendar and not by the number of readings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.operators.ordered import arrange, number
from sensorloom.session import freeze

# Fixed values.
HINGES = 25
HINGE_RANGE = 0.8
DAILY_ORDER = 4
WEEKLY_ORDER = 3
HINGE_SCALE = 0.05
SEASON_SCALE = 10.0
# Rounds of the drift's fixed point, and its lower end as a share of the largest value.
DRIFT_ROUNDS = 8
LEAST_DRIFT = 1e-6
MIN_POINTS = 2
MIN_HOURS = 10
HOURS_AHEAD = 7 * 24
# Length of the first regression of an ARIMA fit; a series shorter than 4 times that takes a quarter of its hours.
LONG_ORDER = 12
# Readings of one key whose products one task adds up.
MOMENT_ROWS = 1 << 20
SEASONAL_WEIGHT = 0.6
ARIMA_ORDERS = [(p, d, q) for p in range(3) for d in range(2) for q in range(3)]
DAY_US = 86_400_000_000.0


# ---------------------------------------------------------------- series and grids


def usable_points(readings: DataFrame) -> DataFrame:
    """Readings with a time and a numeric value."""
    return readings.where("time is not null and value is not null and not isnan(value)")


def hourly_mean(readings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean per clock hour; hours without readings are absent."""
    hour = F.date_trunc("hour", "time").alias("hour")
    return usable_points(readings).groupBy(*by, hour).agg(F.avg("value").alias("hourly_mean"))


def future_grid(readings: DataFrame, steps: int, by: Sequence[str] = ()) -> DataFrame:
    """Distinct known times (``step`` null) and ``steps`` further minutes (``step`` 1, 2, ...)."""
    return extend_grid(known_times(readings, by), steps, by)


def known_times(readings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return usable_points(readings).select(*by, F.col("time").alias("timestamp")).distinct()


def extend_grid(known: DataFrame, steps: int, by: Sequence[str] = ()) -> DataFrame:
    """Known times and ``steps`` minutes after the last of each key."""
    last = known.groupBy(*by).agg(F.max("timestamp").alias("_last")).where("_last is not null")
    ahead = last.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps)))).withColumn(
        "timestamp", F.col("_last") + F.make_dt_interval(mins=F.col("step"))
    )
    return known.unionByName(ahead.drop("_last"), allowMissingColumns=True)


def hours_for(steps: int) -> int:
    """Hours that a forecast of ``steps`` minutes reaches into."""
    return -(-steps // 60)


# ---------------------------------------------------------------- seasonal model


def basis_names() -> list[str]:
    names = ["one", "t"] + [f"hinge_{j}" for j in range(1, HINGES + 1)]
    for label, order in (("day", DAILY_ORDER), ("week", WEEKLY_ORDER)):
        names += [f"{label}_{f}{k}" for k in range(1, order + 1) for f in ("sin", "cos")]
    return names


def basis(time: Column, start: Column, end: Column) -> list[Column]:
    """Regression columns of a time: trend with hinges, daily and weekly waves."""
    us = F.unix_micros(time).cast("double")
    low, high = F.unix_micros(start).cast("double"), F.unix_micros(end).cast("double")
    t = F.coalesce(F.try_divide(us - low, high - low), F.lit(0.0))
    columns = [F.lit(1.0), t]
    for j in range(1, HINGES + 1):
        columns.append(F.greatest(F.lit(0.0), t - F.lit(HINGE_RANGE * j / HINGES)))
    for days, order in ((1.0, DAILY_ORDER), (7.0, WEEKLY_ORDER)):
        for k in range(1, order + 1):
            angle = us / F.lit(DAY_US) * F.lit(2 * math.pi * k / days)
            columns += [F.sin(angle), F.cos(angle)]
    return columns


def _periods(points: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per key, written: it is joined to all readings and to the solved models."""
    found = points.groupBy(*by).agg(
        F.min("time").alias("start"),
        F.max("time").alias("end"),
        F.count(F.lit(1)).alias("n"),
        F.max(F.abs("value")).alias("scale"),
    )
    return freeze(found.where(F.col("n") >= MIN_POINTS), "periods")


def _with_model(df: DataFrame, model: DataFrame, by: Sequence[str]) -> DataFrame:
    """Attach the model row of each key; the single row of a pooled model as literals.

    Without a pooled model no row is left, as in the join. A table with more than one row is no
    pooled model.
    """
    if by:
        return df.join(model, list(by))
    rows = model.take(2)
    if len(rows) > 1:
        raise ValueError("models of several keys need the keys they were trained by")
    row = rows[0] if rows else None
    if row is None:
        return df.where("false").withColumns({f.name: F.lit(None).cast(f.dataType) for f in model.schema})
    return df.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in model.schema})


def moments(readings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean cross products of the basis columns and the value: (by, i, j, moment), i <= j.

    Index ``len(basis)`` is the value. A task emits one row per pair for each run of rows of a key.
    """
    points = usable_points(readings)
    return _moments(points, _periods(points, by), by)


def _moments(points: DataFrame, period: DataFrame, by: Sequence[str]) -> DataFrame:
    joined = _with_model(points.select(*by, "time", "value"), period.select(*by, "start", "end", "n"), by)
    width = len(basis_names())
    key = F.to_json(F.struct(*by)) if by else F.lit("")
    if by:
        # Readings of a key come together, long series in parts, so that a task holds one sum at a time.
        joined = joined.withColumn("_part", F.pmod(F.xxhash64("time"), F.ceil(F.col("n") / MOMENT_ROWS)))
        joined = joined.repartition(*by, "_part").sortWithinPartitions(*by, "_part")
    wide = joined.select(
        key.alias("_key"),
        *[c.alias(f"x{i}") for i, c in enumerate(basis(F.col("time"), F.col("start"), F.col("end")))],
        F.col("value").alias(f"x{width}"),
    )
    first, second = np.triu_indices(width + 1)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(k, gram):
            columns = [pa.array([k] * len(first)), pa.array(first), pa.array(second), pa.array(gram[first, second])]
            return pa.RecordBatch.from_arrays(columns, names=["_key", "i", "j", "s"])

        held, total = None, None
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(0).dictionary_encode()
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns[1:]])
            code, names = keys.indices.to_numpy(), keys.dictionary.to_pylist()
            edges = np.r_[0, np.flatnonzero(np.diff(code)) + 1, len(code)]
            for i, j in zip(edges, edges[1:]):
                k, gram = names[code[i]], x[i:j].T @ x[i:j]
                if total is not None and k != held:
                    yield out(held, total)
                    total = None
                held, total = k, gram if total is None else total + gram
        if total is not None:
            yield out(held, total)

    parts = wide.mapInArrow(products, "_key string, i bigint, j bigint, s double")
    sums = parts.groupBy("_key", "i", "j").agg(F.sum("s").alias("s"))
    counts = period.select(*by, "n", key.alias("_key"))
    if not by:
        return _with_model(sums, counts.select("n"), by).select("i", "j", (F.col("s") / F.col("n")).alias("moment"))
    return sums.join(counts, "_key").select(*by, "i", "j", (F.col("s") / F.col("n")).alias("moment"))


def _drift(a, b, yy, n, scale, wide, noise, hinge) -> float:
    """Variance of the changes of slope that makes the data likeliest, by a fixed point over the fit.

    Each round fits with that variance as prior and divides the squared changes by the number of them
    that the data, and not the prior, have decided. The prior of the forecast itself is not changed.
    """
    size = (HINGE_SCALE * scale) ** 2
    for _ in range(DRIFT_ROUNDS):
        penalty = np.diag(noise / n / np.where(hinge, math.sqrt(size), wide) ** 2 + 1e-9)
        inverse = np.linalg.inv(a + penalty)
        coef = inverse @ b
        noise = max(float(yy - 2 * coef @ b + coef @ a @ coef), 0.0)
        decided = float(np.sum(1 - np.minimum(np.diag(inverse)[hinge] * noise / n / size, 1.0)))
        size = max(float(np.sum(coef[hinge] ** 2)) / max(decided, 1e-3), (LEAST_DRIFT * scale) ** 2)
    return size


def _solver(by: Sequence[str]):
    width = len(basis_names())
    hinge = np.zeros(width, bool)
    hinge[2 : 2 + HINGES] = True

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        g = np.zeros((width + 1, width + 1))
        g[rows["i"], rows["j"]] = rows["moment"]
        g = np.triu(g) + np.triu(g, 1).T
        a, b, yy = g[:width, :width], g[:width, width], g[width, width]
        n, scale = float(rows["n"].iloc[0]), max(float(rows["scale"].iloc[0]), 1e-12)
        wide = np.where(hinge, HINGE_SCALE, SEASON_SCALE) * scale
        wide[:2] = np.inf
        variance = max(yy - b[0] ** 2, 0.0)
        # Gaussian priors on the coefficients, with the noise level of the previous fit.
        for _ in range(3):
            penalty = np.diag(variance / n / wide**2 + 1e-9)
            coef = np.linalg.solve(a + penalty, b)
            variance = max(float(yy - 2 * coef @ b + coef @ a @ coef), 0.0)
        row = {k: [rows[k].iloc[0]] for k in by}
        drift = math.sqrt(_drift(a, b, yy, n, scale, wide, variance, hinge))
        return pd.DataFrame({**row, "coef": [coef.tolist()], "sigma": [math.sqrt(variance)], "drift": [drift]})

    return solve


def train_seasonal(readings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Model table (by, start, end, n, coef, sigma, drift); keys with fewer than 2 points have no row.

    ``sigma`` is the noise of the readings, ``drift`` the size of a change of slope at a hinge.
    """
    points = usable_points(readings)
    period = _periods(points, by)
    system = _with_model(_moments(points, period, by), period.select(*by, "n", "scale"), by)
    schema = ", ".join([*[f"{k} {dict(points.dtypes)[k]}" for k in by], "coef array<double>", "sigma double", "drift double"])
    solved = system.groupBy(*by).applyInPandas(_solver(by), schema)
    return _with_model(solved, period.drop("scale"), by)


def trend_variance(ahead: Column, drift: Column) -> Column:
    """Variance of the trend ``ahead`` lengths of the history after its end; zero up to the end.

    Changes of slope are taken to come on at the rate of the hinges, each of size ``drift``. Those to come
    give ahead^3 / 3. The last stretch of the history holds no hinge, so a line was laid through changes
    there, too; the other terms are what continuing that line misses, over all places of a change.
    """
    rest = 1 - HINGE_RANGE
    missed = F.lit(rest) * (F.lit(rest * rest / 105) + F.lit(11 * rest / 105) * ahead + F.lit(13 / 35) * ahead * ahead)
    total = drift * drift * F.lit(HINGES / HINGE_RANGE) * (missed + ahead * ahead * ahead / 3)
    return F.when(ahead > 0, total).otherwise(0.0)


def seasonal_forecast(
    grid: DataFrame, model: DataFrame, by: Sequence[str] = (), width: float = 0.90, widen: bool = False
) -> DataFrame:
    """Point and interval of the seasonal model at every time of the grid.

    With ``widen`` the interval grows with the time since the end of the history, by the changes of
    trend that are to be expected; a model stored without ``drift`` is refused.
    """
    if widen and "drift" not in model.columns:
        raise ValueError("the model holds no drift: train it again for an interval that widens")
    joined = _with_model(grid, model, by)
    point = F.lit(0.0)
    for i, c in enumerate(basis(F.col("timestamp"), F.col("start"), F.col("end"))):
        point = point + F.col("coef")[i] * c
    spread = F.col("sigma")
    if widen:
        us, low, high = (F.unix_micros(c).cast("double") for c in ("timestamp", "start", "end"))
        ahead = F.coalesce(F.try_divide(us - high, high - low), F.lit(0.0))
        spread = F.sqrt(spread * spread + trend_variance(ahead, F.col("drift")))
    half = F.lit(NormalDist().inv_cdf(0.5 + width / 2)) * spread
    return joined.withColumns(
        {"seasonal_point": point, "forecast_lower": point - half, "forecast_upper": point + half}
    ).drop(*[c for c in model.columns if c not in by])


# ---------------------------------------------------------------- ARIMA


def _lags(x: np.ndarray, k: int, start: int) -> np.ndarray:
    """Columns x[t-1] .. x[t-k] for t = start .. len(x)-1."""
    return np.column_stack([x[start - i : len(x) - i] for i in range(1, k + 1)]) if k else np.empty((len(x) - start, 0))


def hannan_rissanen(y: np.ndarray, order: tuple[int, int, int], ahead: int, long_order: int = LONG_ORDER):
    """Fit by two regressions; returns (aic, coefficients, forecast) or None.

    All orders are compared on the same last observations. A fit with an explosive
    autoregression is rejected.
    """
    p, d, q = order
    w = np.diff(y, d) if d else y
    long = min(long_order, len(y) // 4)
    start = long + 3 - d
    if len(w) - start < p + q + 2:
        return None
    constant = np.ones((len(w), 1 - d))
    noise = np.zeros(len(w))
    if q:
        design = np.hstack([np.ones((len(w) - long, 1)), _lags(w, long, long)])
        noise[long:] = w[long:] - design @ np.linalg.lstsq(design, w[long:], rcond=None)[0]
    design = np.hstack([constant[start:], _lags(w, p, start), _lags(noise, q, start)])
    if design.shape[1]:
        coef = np.linalg.lstsq(design, w[start:], rcond=None)[0]
        residual = w[start:] - design @ coef
    else:
        coef, residual = np.empty(0), w[start:]
    c, ar, ma = coef[: 1 - d].sum(), coef[1 - d : 1 - d + p], coef[1 - d + p :]
    if p and np.abs(np.roots(np.r_[1.0, -ar])).max() >= 1:
        return None
    n = len(residual)
    aic = n * math.log(max(residual @ residual / n, 1e-300)) + 2 * (len(coef) + 1)
    known, shocks = list(w), list(np.r_[noise[:start], residual] if q else noise)
    for _ in range(ahead):
        known.append(c + sum(a * known[-i] for i, a in enumerate(ar, 1)) + sum(m * shocks[-i] for i, m in enumerate(ma, 1)))
        shocks.append(0.0)
    future = np.array(known[len(w) :])
    return aic, coef, y[-1] + np.cumsum(future) if d else future


def _order_fits(by: Sequence[str], ahead: int):
    def fit(hours: pd.DataFrame) -> pd.DataFrame:
        y = hours.sort_values("hour")["hourly_mean"].to_numpy(float)
        rows = []
        for order in ARIMA_ORDERS:
            found = hannan_rissanen(y, order, ahead) if len(y) >= MIN_HOURS else None
            aic, coef, ahead_values = found if found else (None, np.empty(0), np.empty(0))
            rows.append((*[hours[k].iloc[0] for k in by], *order, len(y), aic, coef.tolist(), ahead_values.tolist()))
        return pd.DataFrame(rows, columns=[*by, "p", "d", "q", "n_hours", "aic", "coef", "values"])

    return fit


def arima_orders(readings: DataFrame, by: Sequence[str] = (), ahead: int = HOURS_AHEAD) -> DataFrame:
    """Fit of every order: (by, p, d, q, n_hours, aic, coef, values); aic null if rejected.

    The hours of a key meet all orders in one group.
    """
    hours = hourly_mean(readings, by)
    keys = "".join(f"{k} {dict(readings.dtypes)[k]}, " for k in by)
    schema = f"{keys}p int, d int, q int, n_hours bigint, aic double, coef array<double>, values array<double>"
    return hours.groupBy(*by).applyInPandas(_order_fits(by, ahead), schema)


def train_arima(readings: DataFrame, by: Sequence[str] = (), ahead: int = HOURS_AHEAD) -> DataFrame:
    """Best order per key by AIC; keys with fewer than 10 hours have no row."""
    fits = arima_orders(readings, by, ahead).where("aic is not null")
    rank = F.struct("aic", "p", "d", "q")
    best = fits.groupBy(*by).agg(F.min_by(F.struct("p", "d", "q", "n_hours", "aic", "coef", "values"), rank).alias("_b"))
    return best.where("_b is not null").select(*by, "_b.*")


# ---------------------------------------------------------------- blend and errors


def step_hold_blend(minutes: DataFrame, hourly: DataFrame, by: Sequence[str] = (), weight: float = SEASONAL_WEIGHT) -> DataFrame:
    """``ensemble_point`` = weight * ``seasonal_point`` + (1 - weight) * value of the step's hour.

    ``minutes`` has ``step`` 1, 2, ...; ``hourly`` has ``h`` 0, 1, ... and ``hourly_value``.
    Every hour is held for 60 steps, the last one to the end. Rows without a step or without
    hourly values keep the seasonal point.
    """
    last = hourly.groupBy(*by).agg(F.max("h").alias("_last_h"))
    # Only the rows ahead meet the hours: the history, which grows with the data, is not joined.
    history = minutes.where("step is null").withColumn("ensemble_point", F.col("seasonal_point"))
    ahead = minutes.where("step is not null")
    held = ahead.join(last, list(by), "left") if by else ahead.withColumn("_last_h", F.lit(last.first()[0]))
    held = held.withColumn("h", F.least(F.expr("(step - 1) div 60").cast("int"), F.col("_last_h")))
    joined = held.join(hourly, [*by, "h"], "left")
    mixed = F.lit(weight) * F.col("seasonal_point") + F.lit(1 - weight) * F.col("hourly_value")
    blended = joined.withColumn("ensemble_point", F.coalesce(mixed, F.col("seasonal_point")))
    return history.unionByName(blended.drop("h", "_last_h", "hourly_value"))


def hourly_values(arima: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return arima.select(*by, F.posexplode("values").alias("h", "hourly_value"))


def ensemble_forecast(
    grid: DataFrame,
    seasonal: DataFrame,
    arima: DataFrame | None,
    by: Sequence[str] = (),
    width: float = 0.90,
    widen: bool = False,
) -> DataFrame:
    """Forecast table; interval from the seasonal part, blend on future rows only."""
    table = seasonal_forecast(grid, seasonal, by, width, widen)
    if arima is None:
        table = table.withColumn("ensemble_point", F.col("seasonal_point"))
    else:
        table = step_hold_blend(table, hourly_values(arima, by), by)
    return table.select(
        *by,
        "timestamp",
        "step",
        "seasonal_point",
        "ensemble_point",
        F.col("ensemble_point").alias("forecast_point"),
        "forecast_lower",
        "forecast_upper",
    )


def forecast_ensemble(
    readings: DataFrame, steps: int, by: Sequence[str] = (), width: float = 0.90, widen: bool = False
) -> DataFrame:
    """Train both models and forecast ``steps`` minutes beyond the readings."""
    seasonal = freeze(train_seasonal(readings, by), "seasonal")
    arima = freeze(train_arima(readings, by, hours_for(steps)), "arima")
    return ensemble_forecast(future_grid(readings, steps, by), seasonal, arima, by, width, widen)


def forecast_head(forecast: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows of each key in time order, from an ordered pass: no task holds them all."""
    names = forecast.columns
    placed = arrange(forecast, list(by), ["timestamp"])
    return number(placed, list(by), "_at").where(F.col("_at") <= n).select(*names)


def aligned(actual: DataFrame, forecast: DataFrame, align: str = "time", by: Sequence[str] = ()) -> DataFrame:
    """Pairs (actual, forecast) by minute, or by position in time order.

    By position the longer side is cut to the shorter one. The row numbers of both sides come
    from ordered passes.
    """
    actual = usable_points(actual)
    if align == "time":
        left = actual.select(*by, F.date_trunc("minute", "time").alias("_at"), F.col("value").alias("actual"))
        right = forecast.where("step is not null").select(
            *by, F.date_trunc("minute", "timestamp").alias("_at"), F.col("forecast_point").alias("forecast")
        )
    elif align == "position":
        placed = arrange(actual.select(*by, "time", "row_key", "value"), list(by), ["time", "row_key"])
        left = number(placed, list(by), "_at").select(*by, "_at", F.col("value").alias("actual"))
        # Placing a table samples it first: the forecast is written, so that it is not made twice.
        made = freeze(forecast.select(*by, "timestamp", "forecast_point"), "forecast")
        ordered = arrange(made, list(by), ["timestamp"])
        right = number(ordered, list(by), "_at").select(*by, "_at", F.col("forecast_point").alias("forecast"))
    else:
        raise ValueError("align must be 'time' or 'position'")
    return left.join(right, [*by, "_at"])


def forecast_metrics(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """MAE, RMSE and MAPE in percent; pairs with an actual value of 0 do not count for MAPE."""
    e = F.col("actual") - F.col("forecast")
    return pairs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.abs(F.try_divide(e, F.col("actual")))) * 100).alias("mape"),
    )
