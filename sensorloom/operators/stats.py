"""Statistics over a feature table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def feature_statistics(features: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Mean and sample deviation of every numeric column, and the number of windows.

    Every batch gives count, mean and sum of squared deviations of all columns at once; the parts
    are put together by the usual rule for merged variances. Nulls are left out.
    """
    names = list(names or numeric_columns(features))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns])
            n = (~np.isnan(x)).sum(0)
            mean = np.nansum(x, 0) / np.maximum(n, 1)
            square = np.nansum((x - mean) ** 2, 0)
            columns = [pa.array(np.arange(len(names))), pa.array(np.full(len(names), len(x))), pa.array(n), pa.array(mean), pa.array(square)]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "rows", "n", "m", "q"])

    parts = features.select(*[F.col(n).cast("double") for n in names]).mapInArrow(summed, "i bigint, rows bigint, n bigint, m double, q double")
    total = parts.groupBy("i").agg(
        F.sum("rows").alias("n_windows"),
        F.sum("n").alias("n"),
        F.try_divide(F.sum(F.col("n") * F.col("m")), F.sum("n")).alias("mean"),
        F.sum("q").alias("within"),
        F.sum(F.col("n") * F.col("m") * F.col("m")).alias("squares"),
    )
    between = F.greatest(F.col("squares") - F.col("n") * F.col("mean") * F.col("mean"), F.lit(0.0))
    # Rounding of the squares around a large mean is no spread.
    between = F.when(between > F.lit(1e-14) * F.col("squares"), between).otherwise(0.0)
    std = F.sqrt(F.try_divide(F.col("within") + between, F.when(F.col("n") > 1, F.col("n") - 1)))
    listed = F.array(*[F.struct(F.lit(i).cast("bigint").alias("i"), F.lit(n).alias("feature")) for i, n in enumerate(names)])
    every = features.sparkSession.range(1).select(F.explode(listed).alias("e")).select("e.*")
    return every.join(total, "i", "left").select(
        "feature", "mean", std.alias("std"), F.coalesce("n_windows", F.lit(0).cast("bigint")).alias("n_windows")
    )


def top_features(statistics: DataFrame, n: int = 15) -> DataFrame:
    return statistics.orderBy(F.desc_nulls_last("std"), "feature").limit(n)


def feature_correlation(features: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of columns over the rows where both are present.

    Values are centred on the column means first. Every task adds up the cross products of its
    batches as matrix products and emits one row per pair, whatever its number of windows.
    """
    names = list(names or numeric_columns(features))
    means = features.agg(*[F.avg(n).alias(n) for n in names]).first()
    centre = np.array([float(m) if m is not None else 0.0 for m in means])
    first, second = np.triu_indices(len(names))

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((6, len(first)))
        for b in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns]) - centre
            seen = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            n, s, q, xy = seen.T @ seen, x.T @ seen, (x * x).T @ seen, x.T @ x
            total += [m[first, second] for m in (n, s, s.T, q, q.T, xy)]
        columns = [pa.array(first), pa.array(second), *[pa.array(t) for t in total]]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "n", "sx", "sy", "qx", "qy", "xy"])

    schema = "i bigint, j bigint, n double, sx double, sy double, qx double, qy double, xy double"
    parts = features.select(*[F.col(n).cast("double") for n in names]).mapInArrow(products, schema)
    total = parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "qx", "qy", "xy")])
    spread = lambda q, s: F.col(q) - F.try_divide(F.col(s) * F.col(s), F.col("n"))
    both = F.col("xy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    x2, y2 = spread("qx", "sx"), spread("qy", "sy")
    flat = lambda v, q: v <= F.col(q) * F.lit(1e-12)  # noqa: E731  rounding of a constant column
    corr = F.when(~flat(x2, "qx") & ~flat(y2, "qy"), F.try_divide(both, F.sqrt(x2) * F.sqrt(y2)))
    name = F.array(*[F.lit(n) for n in names])
    at = lambda c: F.element_at(name, (F.col(c) + 1).cast("int"))
    pair = lambda a, b: F.struct(at(a).alias("feature_a"), at(b).alias("feature_b"), corr.alias("corr"))
    both_ways = F.when(F.col("i") == F.col("j"), F.array(pair("i", "j")))
    both_ways = both_ways.otherwise(F.array(pair("i", "j"), pair("j", "i")))
    return total.select(F.explode(both_ways).alias("e")).select("e.*")
