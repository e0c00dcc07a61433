"""Feature store that is kept up to date in blocks of time.

A series is cut into buckets of some days. Every bucket has a fingerprint of all that its windows are made from: its own
rows, the rows behind it that its last windows reach into, and where a window begins if not every row does. A run
recomputes the windows of buckets whose fingerprint is not stored, and no others: a day of new readings costs that
day, and a late reading its bucket and the one before. Buckets follow time and not row numbers, so a row that comes
in late does not move all later ones.

Stored rows carry the fingerprint they were made from and are read by it. So a run that died between two buckets, or a
bucket that lost its rows, leaves nothing that is read as current.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.config import PipelineConfig
from sensorloom.operators import labels, quality, windows
from sensorloom.operators.ordered import CHUNK, POS, number
from sensorloom.plans.jobs import Prepared
from sensorloom.session import freeze
from sensorloom.sources.store import FINGERPRINT, _load

BUCKET = "bucket"
PART = ["split", "entity_id", BUCKET]
DAY_US = 86_400_000_000


@dataclass
class Update:
    """``features``: all current ones; ``recomputed``: (split, entity_id, bucket, fingerprint) of what this run made."""

    features: DataFrame
    recomputed: DataFrame


def bucket_of(time: Column, days: int) -> Column:
    return F.floor(F.unix_micros(time) / F.lit(days * DAY_US)).cast("int")


def _hash_sum(h: Column) -> Column:
    """Order-free fingerprint of any number of 64-bit hashes."""
    return F.concat_ws("-", F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h))


def _bucketed(rows: DataFrame, config: PipelineConfig, days: int) -> tuple[DataFrame, list[str]]:
    """Rows with their number in the series that windows run in, their bucket, and a hash of all that counts."""
    keys = windows.series_keys(rows, config.respect_segments)
    if config.respect_segments:
        rows = number(quality.arrange_readings(rows.drop("rn")), keys)
    ignored = {"equipment", "system", "rn", POS, CHUNK} | (set() if config.respect_segments else {"segment_id", "gap_minutes"})
    h = F.xxhash64(*sorted(c for c in rows.columns if c not in ignored))
    return rows.drop(POS, CHUNK).withColumns({BUCKET: bucket_of(F.col("time"), days), "_h": h}), keys


def _spans(bucketed: DataFrame, keys: list[str]) -> DataFrame:
    """A row a bucket of a series: its first and last row number, and the fingerprint of its rows."""
    return bucketed.groupBy(*keys, BUCKET).agg(F.min("rn").alias("first"), F.max("rn").alias("last"), _hash_sum(F.col("_h")).alias("own"))


def _ahead(spans: DataFrame, keys: list[str], size: int) -> DataFrame:
    """(series, rn, bucket) of the up to ``size - 1`` rows behind each bucket that its windows reach into."""
    reach = F.explode(F.sequence(F.col("last") + 1, F.col("last") + size - 1))
    return spans.select(*keys, BUCKET, "last", reach.alias("rn"))


def bucket_fingerprints(rows: DataFrame, config: PipelineConfig, days: int) -> DataFrame:
    """(split, entity_id, bucket, fingerprint) of the buckets in which a window begins."""
    bucketed, keys = _bucketed(rows, config, days)
    return _fingerprints(bucketed, keys, freeze(_spans(bucketed, keys), "spans"), config)


def _fingerprints(bucketed: DataFrame, keys: list[str], spans: DataFrame, config: PipelineConfig) -> DataFrame:
    size, step = config.window_size, config.step
    totals = spans.groupBy(*keys).agg(F.max("last").alias("_rows"))
    # The number of the first window that begins at or after the bucket's first row.
    begin = F.col("first") + F.pmod(1 - F.col("first"), F.lit(step))
    holding = spans.join(totals, keys).where((begin <= F.col("last")) & (begin <= F.col("_rows") - size + 1))
    holding = freeze(holding.drop("_rows"), "holding")
    behind = bucketed.select(*keys, "rn", "_h").join(_ahead(holding, keys, size), [*keys, "rn"])
    placed = F.xxhash64(F.col("rn") - F.col("last"), "_h")
    ahead = behind.groupBy(*keys, BUCKET).agg(_hash_sum(placed).alias("ahead"))
    offset = ((F.col("first") - 1) % step).cast("string")
    of_series = F.concat_ws("/", F.col("own"), F.coalesce("ahead", F.lit("")), offset)
    named = holding.join(ahead, [*keys, BUCKET], "left").withColumn("_f", of_series)
    # A bucket may hold several segments of a series.
    return named.groupBy(*PART).agg(F.sha2(F.concat_ws(" ", F.sort_array(F.collect_list("_f"))), 256).alias(FINGERPRINT))


def _stored(spark, path: str, like: DataFrame | None = None) -> DataFrame | None:
    """Stored rows with keys as the texts they were written as."""
    found = _load(spark, path)
    if found is None:
        return None
    plain = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields if f.name not in PART)
    return spark.read.schema(f"{plain}, split string, entity_id string, {BUCKET} int").parquet(path)


def update_features(prepared: Prepared, path: str, config: PipelineConfig = PipelineConfig(), bucket_days: int = 7) -> Update:
    """Bring the store below ``path`` up to date with the prepared rows, and return the current features.

    Only the partitions of buckets that changed are written. The store's folder depends on the bucket's length and on
    all settings that decide feature values. Give buckets so many days that one holds some MB of features.
    """
    rows, spark = prepared.rows, prepared.rows.sparkSession
    path = f"{path}/{config.feature_hash()}-{bucket_days}d"
    bucketed, keys = _bucketed(rows, config, bucket_days)
    if config.respect_segments:
        bucketed = freeze(bucketed, "bucketed")
    spans = freeze(_spans(bucketed, keys), "spans")
    wanted = freeze(_fingerprints(bucketed, keys, spans, config), "wanted")
    stored = _stored(spark, path)
    dirty = wanted if stored is None else wanted.join(stored.select(*PART, FINGERPRINT).distinct(), [*PART, FINGERPRINT], "left_anti")
    dirty = freeze(dirty, "dirty")
    if not dirty.isEmpty():
        made = _features(bucketed, keys, spans, dirty, config).join(dirty, PART)
        order = [*PART, "window_start"]
        placed = made.hint("rebalance", *PART).sortWithinPartitions(*order)
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*PART).parquet(path)
        stored = _stored(spark, path)
    if stored is None:
        empty = _features(bucketed, keys, spans, dirty, config)
        return Update(empty.drop(BUCKET), dirty)
    return Update(stored.join(wanted, [*PART, FINGERPRINT], "left_semi").drop(BUCKET, FINGERPRINT), dirty)


def _features(bucketed: DataFrame, keys: list[str], spans: DataFrame, dirty: DataFrame, config: PipelineConfig) -> DataFrame:
    """Features of the windows that begin in the given buckets.

    Each bucket becomes a series of its own: its rows and those behind it that its windows need. The latter are too few
    to hold a window, so a window belongs to the bucket of its first row.
    """
    needed = [*keys, "rn", "time", "value"]
    own = bucketed.join(dirty.select(*PART), PART, "left_semi").select(*needed, BUCKET)
    reach = _ahead(spans.join(dirty.select(*PART), PART, "left_semi"), keys, config.window_size).drop("last")
    behind = bucketed.select(*needed).join(reach, [*keys, "rn"]).select(*needed, BUCKET)
    table = windows.extract_features(own.unionByName(behind), [*keys, BUCKET], config.window_size, config.step, rn="rn")
    if "anomaly_label" not in bucketed.columns:
        return table.withColumn("anomaly_label", F.lit(None).cast("int"))
    return labels.center_label(table, bucketed.where("anomaly_label is not null"), keys)
