"""Labels of readings carried over to windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.operators.ordered import arrange, fill
from sensorloom.operators.quality import unplaced


def _first_per_time(readings: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """One label per time: that of the first row among equal times."""
    return readings.groupBy(*keys, "time").agg(F.min_by(F.struct(F.col(label).alias("label")), "row_key").alias("_seen"))


def center_label(windows: DataFrame, readings: DataFrame, keys: Sequence[str], label: str = "anomaly_label") -> DataFrame:
    """Label of the reading at the window centre.

    The centre is the time of one of the window's own rows, so the nearest reading is at
    distance 0 and the nearest join is an equi-join. Series without labels get null.
    """
    seen = _first_per_time(readings, keys, label).withColumnRenamed("time", "window_center")
    joined = windows.join(seen, [*keys, "window_center"], "left")
    return joined.withColumn(label, F.col("_seen.label").cast("int")).drop("_seen")


def nearest_label(
    points: DataFrame,
    readings: DataFrame,
    keys: Sequence[str],
    at: str = "window_center",
    label: str = "anomaly_label",
    partitions: int | None = None,
) -> DataFrame:
    """As-of join in both directions: the label of the reading closest in time.

    The earlier reading wins a tie, and the first row wins among equal times. The distinct
    times of both tables go into one ordered pass; there is no range condition and no pair of
    rows to test. The answer per time is then joined back to the points.
    """
    seen = _first_per_time(readings, keys, label).select(
        *keys, "time", F.struct("time", F.col("_seen.label")).alias("_seen"), F.lit(True).alias("_kind")
    )
    asked = points.select(*keys, F.col(at).alias("time")).distinct().withColumn("_kind", F.lit(False))
    union = asked.unionByName(seen, allowMissingColumns=True)
    # Points sort before the reading of the same time, which is then the next one, at distance 0.
    placed = arrange(union, keys, ["time", "_kind"], partitions)
    placed = unplaced(fill(placed, keys, {"_prev": "_seen"}, {"_next": "_seen"}))

    def distance(c: str) -> Column:
        return F.abs(F.timestamp_diff("MICROSECOND", F.col(f"{c}.time"), F.col("time")))

    use_prev = F.col("_next").isNull() | (distance("_prev") <= distance("_next"))
    nearest = F.when(use_prev, F.col("_prev.label")).otherwise(F.col("_next.label"))
    answers = placed.where(~F.col("_kind")).select(*keys, F.col("time").alias(at), nearest.cast("int").alias(label))
    return points.join(answers, [*keys, at], "left")


def binary_label(label: Column) -> Column:
    """1 for label 1, 0 for everything else; a missing label counts as normal."""
    return F.coalesce(label == 1, F.lit(False)).cast("int")
