"""Gap segments while the readings arrive: a segment is closed once the watermark has passed its gap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.operators.ordered import CHUNK, POS, arrange, number
from sensorloom.streaming.live import prepare


def stream_segments(readings: DataFrame, max_gap_minutes: float, delay: str = "1 hour") -> DataFrame:
    """Closed segments of each series: (entity_id, n_rows, start_time, end_time, mean_value).

    A reading begins a segment if it lies more than ``max_gap_minutes`` after the one before it. A segment is given out
    once, when the latest time seen less ``delay`` is a gap beyond its last reading; later rows for it are dropped.
    Segments that are split over tasks are merged in each task before they meet. Rows without a series only move the time on.
    """
    prepare(readings.sparkSession)
    gap = F.session_window("time", f"{round(max_gap_minutes * 60_000_000)} microseconds")
    timed = readings.withWatermark("time", delay)
    found = timed.groupBy("entity_id", gap).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("time").alias("start_time"),
        F.max("time").alias("end_time"),
        F.avg("value").alias("mean_value"),
        F.count("entity_id").alias("_of_series"),
    )
    # Not a condition on the key: that would be moved below the watermark and take the end of a stream away.
    return found.where("_of_series > 0").select("entity_id", "n_rows", "start_time", "end_time", "mean_value")


def numbered(closed: DataFrame) -> DataFrame:
    """Closed segments with ``segment_id``, counted from 0 in each series as in the batch."""
    ordered = number(arrange(closed, ["entity_id"], ["start_time"]), ["entity_id"])
    return ordered.withColumn("segment_id", F.col("rn") - 1).drop("rn", POS, CHUNK)
