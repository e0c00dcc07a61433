"""Stored sketches: distinct counts and quantiles of any period without reading its rows again.

A day of a series becomes one row of mergeable sketches (HyperLogLog for distinct counts, KLL for ranks), a few KB
whatever the number of readings. A period is the merge of its days, over series as well if they are left out of the
keys. Sketches are built on the map side, so a series or a day with a third of all readings is no hot key.

Errors are those of the sketches: a distinct count has a standard error of 1.04 / sqrt(2^lg_k) (1.6 % here), and
a quantile is a value whose rank is off by at most ``RANK_ERROR`` of the rows with 99 % confidence.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K = 12
KLL_K = 400
DISTINCT_ERROR = 1.04 / 2 ** (LG_K / 2)
RANK_ERROR = 0.0075  # of both sides at KLL_K, 99 %: about 2.4 / k ** 0.96
DAY = "day"


def daily_sketches(readings: DataFrame, keys: Sequence[str], distinct: dict[str, Column], col: str = "value") -> DataFrame:
    """(keys, day, n, a distinct sketch for each name in ``distinct``, quantiles): null values count for neither.

    NaN and infinite readings have no rank and are left out of ``quantiles`` and ``n``.
    """
    x = F.col(col).cast("double")
    ranked = F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)
    counted = [F.hll_sketch_agg(F.when(c.isNotNull(), F.xxhash64(c)), LG_K).alias(name) for name, c in distinct.items()]
    day = F.to_date("time").alias(DAY)
    rows = readings.withColumn(DAY, day)
    return rows.groupBy(*keys, DAY).agg(F.count(ranked).alias("n"), *counted, F.kll_sketch_agg_double(ranked, F.lit(KLL_K)).alias("quantiles"))


def write_sketches(sketches: DataFrame, path: str) -> None:
    """Store by day; only the days present in ``sketches`` are replaced."""
    placed = sketches.hint("rebalance", DAY)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_sketches(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Stored sketches of the days from ``first`` to ``last``; other days are not read."""
    stored = spark.read.parquet(path).withColumn(DAY, F.col(DAY).cast("date"))
    if first:
        stored = stored.where(F.col(DAY) >= F.lit(first))
    if last:
        stored = stored.where(F.col(DAY) <= F.lit(last))
    return stored


def merge_sketches(sketches: DataFrame, keys: Sequence[str], distinct: Sequence[str]) -> DataFrame:
    """One row of sketches for each of the coarser ``keys``; the result can be merged again."""
    unions = [F.hll_union_agg(c).alias(c) for c in distinct]
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), *unions, F.kll_merge_agg_double("quantiles", F.lit(KLL_K)).alias("quantiles"))


def estimates(merged: DataFrame, keys: Sequence[str], distinct: Sequence[str], levels: dict[str, float]) -> DataFrame:
    """(keys, n, estimated distinct counts, a quantile for each name in ``levels``); quantiles of nothing are null."""
    counts = [F.hll_sketch_estimate(c).alias(c) for c in distinct]
    values = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("quantiles", F.lit(p))).alias(name) for name, p in levels.items()]
    return merged.select(*keys, "n", *counts, *values)
