"""Alert episodes: scores and forecast intervals together, opened and closed with hysteresis.

An episode opens after some hot windows in a row and closes after some calm ones in a row; windows between both levels
change nothing. So the state after a window is that of the last window at which such a run was complete, and runs are
differences of row numbers. Both are carried from chunk to chunk by fills, and no series is stepped through in a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.operators.ordered import CHUNK, POS, arrange, fill, number, previous, running_sum
from sensorloom.session import freeze


def forecast_band(windows: DataFrame, forecast: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Windows with ``n_forecast``, ``band_lower``, ``band_upper``: the mean interval over the forecast times they span.

    A window spans the times from its start to its end, both included; without any in the forecast the band is null.
    Forecast rows and the windows' two ends go through one ordered pass with running sums, so there is no range
    condition, and a window over a long gap costs no more than a short one. ``by`` are the forecast's keys.
    """
    by = list(by)
    held = freeze(windows.withColumn("_id", F.monotonically_increasing_id()), "windows")
    points = forecast.where("forecast_lower is not null and forecast_upper is not null").select(
        *by, F.col("timestamp").alias("time"), F.lit(1).alias("_kind"), F.col("forecast_lower").alias("_low"), F.col("forecast_upper").alias("_high")
    )
    # An end takes in the forecast of its own instant, a start leaves it out of what is taken away.
    ends = held.select(
        *by, "_id", F.explode(F.array(F.struct(F.col("window_start").alias("time"), F.lit(0).alias("_kind")), F.struct(F.col("window_end").alias("time"), F.lit(2).alias("_kind")))).alias("e")
    ).select(*by, "_id", "e.*")
    placed = arrange(points.unionByName(ends, allowMissingColumns=True), by, ["time", "_kind", "_id"])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    sums = running_sum(placed, by, {"n": (F.col("_kind") == 1).cast("bigint"), "low": zero("_low"), "high": zero("_high")})
    sign = F.col("_kind") - 1
    spans = sums.where("_kind != 1").groupBy("_id").agg(*[F.sum(sign * F.col(c)).alias(f"_{c}") for c in ("n", "low", "high")])
    n = F.when(F.col("_n") > 0, F.col("_n"))
    return held.join(spans, "_id").withColumns({"n_forecast": F.col("_n"), "band_lower": F.col("_low") / n, "band_upper": F.col("_high") / n}).drop("_id", "_n", "_low", "_high")


def episode_states(windows: DataFrame, keys: Sequence[str], order: Sequence[str], hot: Column, calm: Column, n_open: int, n_close: int) -> DataFrame:
    """Windows in order with ``rn``, ``n_rows`` of the series, ``is_open`` and the number of its ``episode`` (0: none yet)."""
    if n_open < 1 or n_close < 1:
        raise ValueError("n_open and n_close must be at least 1")
    keys = list(keys)
    told = lambda c: F.coalesce(c, F.lit(False))
    flagged = windows.withColumns({"_hot": told(hot), "_calm": told(calm) & ~told(hot)})
    rows = number(arrange(flagged, keys, order), keys, total="n_rows")
    rows = rows.withColumns({"_not_hot": F.when(~F.col("_hot"), F.col("rn")), "_not_calm": F.when(~F.col("_calm"), F.col("rn"))})
    runs = fill(freeze(rows, "flagged"), keys, {"_cold": "_not_hot", "_warm": "_not_calm"})
    run = lambda c: F.col("rn") - F.coalesce(c, F.lit(0))
    decided = F.when(run("_cold") >= n_open, 1).when(run("_warm") >= n_close, 0)
    states = fill(freeze(runs.withColumn("_decided", decided).drop("_not_hot", "_not_calm", "_cold", "_warm"), "decided"), keys, {"_state": "_decided"})
    states = freeze(states.withColumn("_state", F.coalesce("_state", F.lit(0))).drop("_decided"), "states")
    opened = freeze(previous(states, keys, {"_before": "_state"}), "opened")
    begins = ((F.col("_state") == 1) & (F.coalesce("_before", F.lit(0)) == 0)).cast("bigint")
    out = running_sum(opened, keys, {"episode": begins})
    return out.withColumn("is_open", F.col("_state") == 1).drop("_hot", "_calm", "_state", "_before", POS, CHUNK)


def alert_episodes(
    windows: DataFrame,
    keys: Sequence[str],
    score: str,
    high: float,
    low: float,
    n_open: int = 3,
    n_close: int = 5,
    forecast: DataFrame | None = None,
    by: Sequence[str] = (),
    value: str = "mean_oxygen",
    order: Sequence[str] = ("window_start", "window_end"),
) -> DataFrame:
    """Episodes (keys, episode, start_time, end_time, n_windows, peak_score, n_off_forecast, is_closed) of each series.

    A window is hot if its score is at least ``high``, or at least ``low`` while its ``value`` lies outside the forecast's
    band; it is calm if its score is below ``low`` and its value is not outside. An episode begins with the window that
    completes ``n_open`` hot ones in a row and ends before the one that completes ``n_close`` calm ones. A null
    score is neither hot nor calm. ``order`` should end in what tells windows of one series apart.
    """
    if low > high:
        raise ValueError("low must not be above high")
    banded = forecast_band(windows, forecast, by) if forecast is not None else windows.withColumns({"band_lower": F.lit(None).cast("double"), "band_upper": F.lit(None).cast("double")})
    off = F.coalesce((F.col(value) < F.col("band_lower")) | (F.col(value) > F.col("band_upper")), F.lit(False))
    x = F.col(score)
    hot, calm = (x >= high) | ((x >= low) & F.col("_off")), (x < low) & ~F.col("_off")
    states = episode_states(banded.withColumn("_off", off), keys, order, hot, calm, n_open, n_close)
    return (
        states.where("is_open")
        .groupBy(*keys, "episode")
        .agg(
            F.min("window_start").alias("start_time"),
            F.max("window_end").alias("end_time"),
            F.count(F.lit(1)).alias("n_windows"),
            F.max(score).alias("peak_score"),
            F.count_if("_off").alias("n_off_forecast"),
            (F.max("rn") < F.max("n_rows")).alias("is_closed"),
        )
    )
