"""Stored features, predictions and models."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.config import PipelineConfig
from sensorloom.operators.forest import ForestModel
from sensorloom.sources.readings import InputError


FINGERPRINT = "made_from"  # of the rows a stored part was made from


def _load(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


# ---------------------------------------------------------------- features


def write_features(features: DataFrame, path: str) -> None:
    """Store by split and series; only the partitions present in ``features`` are replaced.

    Rows are rebalanced by partition first: a task writes few series, AQE splits a long one over
    several, and the features are computed once, not once more for a sample.
    """
    order = ["split", "entity_id", "window_start"]
    placed = features.hint("rebalance", "split", "entity_id").sortWithinPartitions(*order)
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("split", "entity_id").parquet(path)


def read_features(spark: SparkSession, path: str, split: str | None = None, entity: str | None = None) -> DataFrame:
    """Stored features, pruned to the partitions asked for."""
    stored = _load(spark, path)
    if stored is None:
        raise InputError(f"no features stored at {path}")
    if split:
        stored = stored.where(F.col("split") == split)
    if entity:
        stored = stored.where(F.col("entity_id") == entity)
    typed = {"split": F.col("split").cast("string"), "entity_id": F.col("entity_id").cast("string")}
    return stored.withColumns(typed).drop(FINGERPRINT)


def stored_entities(spark: SparkSession, path: str) -> DataFrame:
    """Sorted series that have training features; empty if nothing is stored."""
    stored = _load(spark, path)
    if stored is None:
        return spark.createDataFrame([], "entity_id string")
    train = stored.where(F.col("split") == "train")
    return train.select(F.col("entity_id").cast("string")).distinct().orderBy("entity_id")


def stored_parts(spark: SparkSession, path: str) -> DataFrame:
    """(entity_id, split, fingerprint) of the stored parts; a part stored without one has a null."""
    stored = _load(spark, path)
    if stored is None:
        return spark.createDataFrame([], f"entity_id string, split string, {FINGERPRINT} string")
    made = F.col(FINGERPRINT) if FINGERPRINT in stored.columns else F.lit(None).cast("string").alias(FINGERPRINT)
    return stored.select(F.col("entity_id").cast("string"), F.col("split").cast("string"), made).distinct()


def check_features(spark: SparkSession, path: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split wanted series into (missing, existing) by presence of training features."""
    have = stored_entities(spark, path)
    return ids.join(have, "entity_id", "left_anti"), ids.join(have, "entity_id", "left_semi")


def combine(*tables: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side become null."""
    first, *rest = tables
    for t in rest:
        first = first.unionByName(t, allowMissingColumns=True)
    return first


# ---------------------------------------------------------------- predictions


def write_predictions(predictions: DataFrame, path: str, forecast: DataFrame | None = None, fmt: str = "csv") -> None:
    predictions.write.mode("overwrite").option("header", True).format(fmt).save(f"{path}/anomaly_predictions")
    if forecast is not None:
        forecast.write.mode("overwrite").option("header", True).format(fmt).save(f"{path}/forecast")


# ---------------------------------------------------------------- models


def _write_meta(spark: SparkSession, meta: dict[str, str], path: str) -> None:
    spark.createDataFrame(list(meta.items()), "key string, value string").write.mode("overwrite").parquet(f"{path}/meta")


def _read_meta(spark: SparkSession, path: str) -> dict[str, str] | None:
    meta = _load(spark, f"{path}/meta")
    return None if meta is None else {r.key: r.value for r in meta.collect()}


def save_forest(model: ForestModel, path: str, config: PipelineConfig | None = None) -> None:
    """Store a detector, with the settings it was trained under."""
    model.scaler.write.mode("overwrite").parquet(f"{path}/scaler")
    model.nodes.write.mode("overwrite").parquet(f"{path}/forest")
    settings = {"config": config.to_json()} if config else {}
    _write_meta(model.nodes.sparkSession, model.meta() | settings, path)


def load_forest(spark: SparkSession, path: str) -> ForestModel:
    values = _read_meta(spark, path)
    if values is None:
        raise InputError(f"no detector stored at {path}")
    return ForestModel(
        values["names"].split(","),
        spark.read.parquet(f"{path}/scaler"),
        spark.read.parquet(f"{path}/forest"),
        int(values["sample_size"]),
        float(values["offset"]),
    )


def load_config(spark: SparkSession, path: str) -> PipelineConfig | None:
    """Settings that a stored model was trained under, if they were stored."""
    values = _read_meta(spark, path) or {}
    return PipelineConfig.from_json(values["config"]) if "config" in values else None


def save_forecaster(
    path: str, known: DataFrame, seasonal: DataFrame, arima: DataFrame | None, by: Sequence[str] = (), config: PipelineConfig | None = None
) -> None:
    """Store both models, the known times the forecast grid starts from, and the keys they were trained by.

    Whether there is an ARIMA model is part of what is stored: an older one in the folder is not used.
    """
    known.write.mode("overwrite").parquet(f"{path}/history")
    seasonal.write.mode("overwrite").parquet(f"{path}/seasonal")
    if arima is not None:
        arima.write.mode("overwrite").parquet(f"{path}/arima")
    meta = {"by": json.dumps(list(by)), "arima": str(arima is not None)} | ({"config": config.to_json()} if config else {})
    _write_meta(known.sparkSession, meta, path)


def load_forecaster(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame | None, list[str]] | None:
    """(known times, seasonal, arima, by), or None if no forecaster was stored."""
    meta = _read_meta(spark, path)
    if meta is None:
        return None
    arima = _load(spark, f"{path}/arima") if meta["arima"] == "True" else None
    return spark.read.parquet(f"{path}/history"), spark.read.parquet(f"{path}/seasonal"), arima, json.loads(meta["by"])
