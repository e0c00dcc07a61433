"""Exact quantile of a column without sorting it in one place."""

from __future__ import annotations

from math import isfinite

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.columns import equal_width_bin

BINS = 1 << 16


def value_at_rank(df: DataFrame, col: str, rank: int) -> tuple[float, int]:
    """Value of 0-based ``rank`` in ascending order, and the number of values up to it.

    Each round counts equal-width bins of the current range (at most 65,536 groups, combined
    on the map side) and narrows the range to the bin that holds the rank, until that bin has
    one distinct value. Every round shrinks the range 65,536-fold, however the values are
    spread and however many are equal.
    """
    below, part = 0, df.select(F.col(col).cast("double").alias("x")).where("x is not null and not isnan(x)")
    low, high = part.agg(F.min("x"), F.max("x")).first()
    while low < high and not isfinite(high - low):
        # Infinite ends, or a range too wide for a double, have no equal bins: cut at zero and the ends.
        side = F.when(F.col("x") == float("-inf"), 0).when(F.col("x") < 0, 1).when(F.col("x") < float("inf"), 2).otherwise(3)
        counts = part.groupBy(side.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        for row in sorted(counts.collect()):
            if below + row.n > rank:
                break
            below += row.n
        low, high = row.low, row.high
        part = part.where(F.col("x").between(low, high))
    while low < high:
        binned = part.groupBy(equal_width_bin(F.col("x"), F.lit(low), F.lit(high), BINS).alias("bin"))
        counts = binned.agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        for row in sorted(counts.collect()):  # at most BINS rows
            if below + row.n > rank:
                break
            below += row.n
        low, high = row.low, row.high
        part = part.where(F.col("x").between(low, high))
    return low, below + part.where(F.col("x") == low).count()


def exact_quantile(df: DataFrame, col: str, p: float) -> float | None:
    """Linear-interpolation quantile of the values that are neither null nor NaN; null if there are none.

    Reads ``df`` a few times: pass a written or cached table if it is costly.
    """
    df = df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
    n = df.count()
    if not n:
        return None
    at = p * (n - 1)
    rank = int(at)
    value, upto = value_at_rank(df, col, rank)
    if at == rank or upto > rank + 1:
        return value
    following = df.where(F.col(col) > value).agg(F.min(col)).first()[0]
    share = at - rank
    return value * (1 - share) + following * share if not isfinite(following - value) else value + (following - value) * share
