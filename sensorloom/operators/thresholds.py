"""Alert thresholds of each series from its own peaks.

A threshold for very rare values can't be read off a series that has none yet. So the excesses over a high, exact
quantile are fitted by a generalised Pareto distribution, and the value that is exceeded with a given risk follows from
it. The fit is by moments: one grouped aggregation, for any number of series and any length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.columns import equal_width_bin
from sensorloom.session import freeze

BINS = 4096
#: A series with so few values left in question has them ranked in its group.
FEW = 4096


def usable(col: str) -> Column:
    x = F.col(col).cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def series_quantile(df: DataFrame, keys: Sequence[str], col: str, level: float, few: int = FEW, bins: int = BINS) -> DataFrame:
    """(keys, n, value): the smallest value of each series that at least ``level`` of its finite values do not exceed.

    All series narrow at once. A round counts equal-width bins of what is still in question (combined on the map side, so
    a series may have any share of the rows) and keeps the bin that holds the rank, until each series has few values
    left, or equal ones; these are then ranked. Every round shrinks a range ``bins``-fold.
    """
    keys = list(keys)
    values = df.where(usable(col)).select(*keys, F.col(col).cast("double").alias("x"))
    state = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
    rank = F.greatest(F.ceil(F.lit(level) * F.col("n")) - 1, F.lit(0))
    state = freeze(state.withColumns({"rank": rank, "left": F.col("n")}), "ranks")
    open_ones = (F.col("low") < F.col("high")) & (F.col("left") > few)
    while not (asked := state.where(open_ones)).isEmpty():
        inside = values.join(asked.drop("n"), keys).where(F.col("x").between(F.col("low"), F.col("high")))
        counted = inside.groupBy(*keys, equal_width_bin(F.col("x"), F.col("low"), F.col("high"), bins).alias("bin")).agg(
            F.count(F.lit(1)).alias("c"), F.min("x").alias("_low"), F.max("x").alias("_high")
        )
        # At most ``bins`` rows a series.
        upto = F.sum("c").over(Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
        found = asked.join(counted.withColumn("_upto", upto), keys).where((F.col("_upto") > F.col("rank")) & (F.col("_upto") - F.col("c") <= F.col("rank")))
        narrowed = found.select(*keys, "n", F.col("_low").alias("low"), F.col("_high").alias("high"), (F.col("rank") - F.col("_upto") + F.col("c")).alias("rank"), F.col("c").alias("left"))
        state = freeze(state.where(~open_ones).unionByName(narrowed.select(state.columns)), "ranks")
    same, rest = state.where("low = high"), state.where("low < high")
    inside = values.join(rest, keys).where(F.col("x").between(F.col("low"), F.col("high")))
    ranked = inside.groupBy(*keys, "n", "rank").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    picked = ranked.select(*keys, "n", F.element_at("xs", (F.col("rank") + 1).cast("int")).alias("value"))
    return same.select(*keys, "n", F.col("low").alias("value")).unionByName(picked)


def _towards(col: str, tail: str) -> Column:
    if tail not in ("upper", "lower"):
        raise ValueError("tail must be 'upper' or 'lower'")
    return F.col(col).cast("double") * (1.0 if tail == "upper" else -1.0)


def peak_thresholds(df: DataFrame, keys: Sequence[str], col: str, level: float = 0.98, risk: float = 1e-3, tail: str = "upper") -> DataFrame:
    """(keys, n_rows, peak_level, n_peaks, shape, scale, alert_level) of each series.

    Peaks are the values beyond the ``level`` quantile of the series; ``alert_level`` is exceeded by a share of ``risk`` of
    its values if their excesses follow the fitted distribution. Without two different peaks the excesses count as
    exponential, without any the alert level is the peak level, beyond which it always lies. ``tail="lower"``
    looks below. Null, NaN and infinite values do not count; a series without others has no row.
    """
    if not 0 < level < 1 or not 0 < risk < 1:
        raise ValueError("level and risk must be in (0, 1)")
    keys = list(keys)
    values = df.where(usable(col)).select(*keys, _towards(col, tail).alias("x"))
    at = freeze(series_quantile(values, keys, "x", level).withColumnRenamed("value", "t"), "levels")
    excess = F.when(F.col("x") > F.col("t"), F.col("x") - F.col("t"))
    fitted = values.join(at, keys).groupBy(*keys, "n", "t").agg(F.count(excess).alias("n_peaks"), F.avg(excess).alias("m"), F.var_pop(excess).alias("v"))
    ratio = F.try_divide(F.col("m") * F.col("m"), F.when(F.col("v") > 1e-12 * F.col("m") * F.col("m"), F.col("v")))
    fitted = fitted.withColumns({"shape": F.coalesce(0.5 * (1 - ratio), F.lit(0.0)), "scale": F.coalesce(0.5 * F.col("m") * (1 + ratio), "m", F.lit(0.0))})
    share = F.lit(risk) * F.col("n") / F.col("n_peaks")
    curved = F.try_divide(F.col("scale"), F.col("shape")) * (F.pow(share, -F.col("shape")) - 1)
    beyond = F.when(F.col("n_peaks") == 0, 0.0).when(F.abs("shape") < 1e-9, -F.col("scale") * F.log(share)).otherwise(curved)
    sign = F.lit(1.0 if tail == "upper" else -1.0)
    return fitted.select(
        *keys,
        F.col("n").alias("n_rows"),
        (sign * F.col("t")).alias("peak_level"),
        "n_peaks",
        "shape",
        "scale",
        (sign * (F.col("t") + F.greatest(beyond, F.lit(0.0)))).alias("alert_level"),
    )


def flag_peaks(df: DataFrame, thresholds: DataFrame, keys: Sequence[str], col: str, tail: str = "upper") -> DataFrame:
    """``df`` with ``is_alert``: beyond the alert level of its series; values that do not count are none.

    Thresholds have a row a series and are written first, so they are sent to the rows as long as they are small.
    """
    levels = freeze(thresholds.select(*keys, F.col("alert_level").alias("_alert")), "alert-levels")
    beyond = _towards(col, tail) > F.col("_alert") * (1.0 if tail == "upper" else -1.0)
    return df.join(levels, list(keys), "left").withColumn("is_alert", usable(col) & F.coalesce(beyond, F.lit(False))).drop("_alert")
