"""Profiles, gap segments and the time split of cleaned readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.columns import minutes_between
from sensorloom.operators.ordered import CHUNK, POS, arrange, local_window, previous
from sensorloom.session import freeze

SERIES = ["entity_id"]
ORDER = ["time", "row_key"]


def load_profile(readings: DataFrame) -> DataFrame:
    """One row: size, period, null share and number of devices and systems.

    Counted per (equipment, system) first: the distinct counts then read that small table.
    """
    pairs = readings.groupBy("equipment", "system").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("time").alias("first"),
        F.max("time").alias("last"),
        F.count_if(F.col("value").isNull()).alias("nulls"),
    )
    n, nulls = F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("nulls"), F.lit(0))
    return pairs.agg(
        n.alias("n_records"),
        F.min("first").alias("min_time"),
        F.max("last").alias("max_time"),
        nulls.alias("null_count"),
        F.try_divide(nulls * F.lit(100.0), n).alias("null_pct"),
        F.count_distinct("equipment").alias("n_equipment"),
        F.count_distinct("system").alias("n_systems"),
    )


def entities(readings: DataFrame) -> DataFrame:
    return readings.select("entity_id").distinct()


def entity_readings(readings: DataFrame, entity: str) -> DataFrame:
    return readings.where(F.col("entity_id") == entity)


def clean(readings: DataFrame) -> DataFrame:
    """Drop null readings; a series without any reading disappears with them."""
    return readings.where("value is not null")


def entity_profile(readings: DataFrame) -> DataFrame:
    """Per series: clean rows, span in hours, mean, sample deviation and null readings."""
    seen = F.when(F.col("value").isNotNull(), F.col("time"))
    return (
        readings.groupBy("entity_id")
        .agg(
            F.count("value").alias("n_records"),
            (minutes_between(F.min(seen), F.max(seen)) / 60).alias("time_span_hours"),
            F.avg("value").alias("mean_value"),
            F.stddev_samp("value").alias("std_value"),
            F.count_if(F.col("value").isNull()).alias("null_count"),
        )
        .where("n_records > 0")
    )


def arrange_readings(readings: DataFrame, partitions: int | None = None, keep_keys: bool = False) -> DataFrame:
    """Readings in (series, time, row) order, ready for the ordered operators.

    The two key texts behind ``entity_id`` are not shuffled along unless ``keep_keys``.
    """
    wanted = readings if keep_keys else readings.drop("equipment", "system")
    return arrange(wanted, SERIES, ORDER, partitions)


def time_delta(arranged: DataFrame) -> DataFrame:
    """Minutes since the previous reading of the series (null for the first)."""
    withprev = previous(arranged, SERIES, {"_prev": "time"})
    return withprev.withColumn("gap_minutes", minutes_between(F.col("_prev"), F.col("time"))).drop("_prev")


def segments(arranged: DataFrame, max_gap_minutes: float) -> DataFrame:
    """``segment_id`` counts the gaps longer than ``max_gap_minutes`` seen so far in the series.

    One local window per chunk finds its gaps and counts them; a summary with the chunk's first
    and last time and its number of gaps then corrects the first row's gap and all counts. One
    shuffle and one write of the rows.
    """
    at = local_window(SERIES)
    gap = minutes_between(F.lag("time").over(at), F.col("time"))
    local = arranged.withColumn("gap_minutes", gap)
    jump = F.when(F.col("gap_minutes") > max_gap_minutes, 1).otherwise(0).cast("bigint")
    so_far = F.sum(jump).over(at.rowsBetween(Window.unboundedPreceding, 0))
    local = local.withColumns({"_jumps": so_far, "_first": F.row_number().over(at) == 1})
    local = freeze(local, "gaps")
    chunks = local.groupBy(*SERIES, CHUNK).agg(F.min("time").alias("_from"), F.max("time").alias("_to"), F.max("_jumps").alias("_n"))
    earlier = Window.partitionBy(*SERIES).orderBy(CHUNK)
    border = minutes_between(F.lag("_to").over(earlier), F.col("_from"))
    chunks = chunks.withColumn("_gap", border)
    own_jump = F.when(F.col("_gap") > max_gap_minutes, 1).otherwise(0).cast("bigint")
    before = F.coalesce(F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    carry = chunks.select(*SERIES, CHUNK, "_gap", (before + F.sum(own_jump).over(earlier)).alias("_before"))
    joined = local.join(freeze(carry, "carry"), [*SERIES, CHUNK])
    return joined.withColumns(
        {"gap_minutes": F.when(F.col("_first"), F.col("_gap")).otherwise(F.col("gap_minutes")), "segment_id": F.col("_jumps") + F.col("_before")}
    ).drop("_jumps", "_first", "_gap", "_before")


def gap_report(arranged: DataFrame, max_gap_minutes: float) -> DataFrame:
    long_gap = F.col("gap_minutes") > max_gap_minutes
    return (
        time_delta(arranged)
        .groupBy("entity_id")
        .agg(
            F.count_if(long_gap).alias("n_gaps"),
            F.max(F.when(long_gap, F.col("gap_minutes"))).alias("max_gap_minutes"),
        )
    )


def segment_counts(segmented: DataFrame) -> DataFrame:
    return segmented.groupBy("entity_id").agg((F.max("segment_id") + 1).alias("n_segments"))


def segment_stats(segmented: DataFrame) -> DataFrame:
    return segmented.groupBy("entity_id", "segment_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("time").alias("start_time"),
        F.max("time").alias("end_time"),
        F.avg("value").alias("mean_value"),
    )


def time_split(cleaned: DataFrame, test_size_days: int) -> DataFrame:
    """``split`` = ``test`` for the last N days of each series, else ``train``.

    Both parts are contiguous in the series order, so an arranged table stays arranged for
    the finer series (entity_id, split).
    """
    cut = F.max("time") - F.make_dt_interval(F.lit(test_size_days))
    cuts = freeze(cleaned.groupBy("entity_id").agg(cut.alias("_cut")), "cuts")
    label = F.when(F.col("time") < F.col("_cut"), "train").otherwise("test")
    return cleaned.join(cuts, "entity_id").withColumn("split", label).drop("_cut")


def split_report(split: DataFrame) -> DataFrame:
    train, test = F.col("split") == "train", F.col("split") == "test"
    return split.groupBy("entity_id").agg(
        F.count_if(train).alias("train_size"),
        F.count_if(test).alias("test_size"),
        F.min(F.when(train, F.col("time"))).alias("train_start"),
        F.max(F.when(train, F.col("time"))).alias("train_end"),
        F.min(F.when(test, F.col("time"))).alias("test_start"),
        F.max(F.when(test, F.col("time"))).alias("test_end"),
    )


def unplaced(df: DataFrame) -> DataFrame:
    """Without the placement columns."""
    return df.drop(POS, CHUNK)


def write_clean(segmented: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Clean rows per series; a long series gets several files, each in order.

    The shuffle is a rebalance: AQE splits the long series by size, and nothing is run twice for a sample.
    """
    placed = unplaced(segmented).hint("rebalance", "entity_id")
    writer = placed.sortWithinPartitions("entity_id", "time", "row_key").write.mode("overwrite")
    writer.partitionBy("entity_id").option("header", True).format(fmt).save(path)
