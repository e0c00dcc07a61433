"""Standard scaling of feature columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.columns import finite_or_zero
from sensorloom.sources.readings import require_columns


NO_SPREAD = 1e-12  # a deviation below this share of the mean's size is rounding noise of a constant column


def model_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named features in order, null and infinite values as 0, other columns kept."""
    require_columns(df, list(names))
    wanted = set(names)
    return df.selectExpr(*[f"{finite_or_zero(c)} as {c}" if c in wanted else c for c in df.columns])


def fit_scaler(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """scaler(feature, mean, std) with the population deviation, in one pass.

    All columns go through one vector aggregate; a hundred scalar aggregates would make one
    method too large to be compiled.
    """
    cleaned = VectorAssembler(inputCols=list(names), outputCol="_x").transform(model_columns(features, names))
    found = cleaned.select(Summarizer.metrics("count", "mean", "variance").summary(F.col("_x")).alias("s"))
    label = F.array(*[F.lit(n) for n in names])
    column = lambda c: vector_to_array(F.col(f"s.{c}"))
    zipped = F.arrays_zip(label.alias("feature"), column("mean").alias("mean"), column("variance").alias("variance"))
    n = F.col("n").cast("double")
    return found.select(F.col("s.count").alias("n"), F.explode(zipped).alias("e")).select(
        "e.feature", "e.mean", F.sqrt(F.try_divide(F.greatest(F.col("e.variance"), F.lit(0.0)) * (n - 1), n)).alias("std")
    )


def scaler_values(scaler: DataFrame) -> dict[str, tuple[float, float]]:
    """The scaler as a driver-side map: one entry per feature."""
    return {r.feature: (r["mean"], r["std"]) for r in scaler.collect()}


def scale(features: DataFrame, names: Sequence[str], scaler: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / std; a column without spread is only centred."""
    cleaned = model_columns(features, names)

    def scaled(n: str) -> str:
        mean, std = scaler[n]
        spread = std if std > NO_SPREAD * abs(mean) else 1.0
        return f"({n} - double('{mean!r}')) / double('{spread!r}') as {n}"

    wanted = set(names)
    return cleaned.selectExpr(*[scaled(c) if c in wanted else c for c in cleaned.columns])
