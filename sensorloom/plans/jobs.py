"""Whole runs: preprocessing, features, detector, forecaster, scoring.

Every job takes and returns DataFrames; what a later job reads again is stored first.
"""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.config import PipelineConfig
from sensorloom.operators import evaluate, forecast, forest, impute, inject, labels, quality, windows
from sensorloom.operators.labels import binary_label
from sensorloom.operators.ordered import number
from sensorloom.session import freeze
from sensorloom.sources import store
from sensorloom.sources.readings import InputError, check_times, read_readings, require_rows

log = logging.getLogger(__name__)
KEYS = ["entity_id", "split"]


@dataclass
class Prepared:
    """Cleaned rows in series order with ``segment_id``, ``split``, ``rn`` and test labels."""

    rows: DataFrame
    entity: str | None
    injection_log: DataFrame | None


def run_preprocessing(
    readings: DataFrame,
    config: PipelineConfig = PipelineConfig(),
    create_faults: bool = True,
    fault_entity: str | None = None,
    path: str | None = None,
) -> Prepared:
    """Clean, segment and split the readings; put faults into one test part; store if asked."""
    # Four tables hold all rows: the readings, parsed once; their placement; the gaps within chunks; and the prepared
    # rows. What is counted over chunks (segments, split, row numbers) lies in summaries joined on the way.
    readings = freeze(readings, "readings")
    require_rows(readings, "readings")
    arranged = quality.arrange_readings(quality.clean(check_times(readings)), keep_keys=bool(path))
    segmented = quality.segments(arranged, config.max_gap_minutes)
    if path:
        quality.write_clean(segmented, path)
    segmented = segmented.drop("equipment", "system")
    rows = freeze(number(quality.time_split(segmented, config.test_size_days), KEYS), "prepared")
    entity = fault_entity or (inject.default_entity(rows) if create_faults else None)
    if not create_faults:
        return Prepared(quality.unplaced(rows), None, None)
    picked = freeze(inject.pick_events(rows.drop("rn"), entity, config.anomaly_fraction), "picked")
    faulty = freeze(inject.inject_events(picked).drop("event_no", "type", "original_value"), "faulty")
    target = (F.col("entity_id") == entity) & (F.col("split") == "test")
    return Prepared(store.combine(quality.unplaced(rows).where(~target), faulty), entity, inject.injection_log(picked))


def run_feature_extraction(
    prepared: Prepared, path: str, config: PipelineConfig = PipelineConfig(), force: bool = False
) -> DataFrame:
    """Extract and store features of the series that are not in the store yet.

    The store's folder depends on all settings that decide feature values. Every stored part carries a
    fingerprint of the rows it was made from, faults and labels included: a series counts as stored once
    all its parts that are long enough for a window are there and were made from the same rows.
    """
    spark = prepared.rows.sparkSession
    path = f"{path}/{config.feature_hash()}"
    rows = prepared.rows
    wanted = freeze(part_fingerprints(rows, config), "wanted")
    stored = store.stored_parts(spark, path)
    if not force:
        missing = wanted.join(stored, [*KEYS, store.FINGERPRINT], "left_anti").select("entity_id").distinct()
        rows = rows.join(freeze(missing, "missing"), "entity_id", "left_semi")
    if not rows.isEmpty():
        store.write_features(features_of(rows, config).join(wanted, KEYS), path)
        stored = store.stored_parts(spark, path)
    # A part that a series no longer has may still lie in the store.
    outdated = stored.join(wanted.select("entity_id").distinct(), "entity_id", "left_semi").join(wanted, [*KEYS, store.FINGERPRINT], "left_anti")
    features = store.read_features(spark, path)
    return features if outdated.isEmpty() else features.join(outdated.select(*KEYS), KEYS, "left_anti")


def part_fingerprints(rows: DataFrame, config: PipelineConfig) -> DataFrame:
    """(entity_id, split, fingerprint) of the parts that hold a window; the same for the same rows in any order."""
    keys = windows.series_keys(rows, config.respect_segments)
    parts = windows.long_enough(rows, keys, config.window_size).select(*KEYS).distinct()
    h = F.xxhash64(*sorted(c for c in rows.columns if c not in ("equipment", "system")))
    made = F.concat_ws("-", F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h))
    return rows.groupBy(*KEYS).agg(made.alias(store.FINGERPRINT)).join(parts, KEYS, "left_semi")


def features_of(rows: DataFrame, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Features of prepared rows; windows take the label of their centre if there are labels."""
    keys = windows.series_keys(rows, config.respect_segments)
    numbered = rows
    if config.respect_segments:
        numbered = number(quality.arrange_readings(rows.drop("rn")), keys)
    table = windows.extract_features(numbered, keys, config.window_size, config.step, rn="rn")
    if "anomaly_label" not in rows.columns:
        return table.withColumn("anomaly_label", F.lit(None).cast("int"))
    return labels.center_label(table, rows.where("anomaly_label is not null"), keys)


def run_detector_training(
    features: DataFrame, config: PipelineConfig = PipelineConfig(), path: str | None = None, labelled_only: bool = False
) -> tuple[forest.ForestModel, DataFrame | None]:
    """Fit on the stored train features of all series; evaluate on the test features.

    Missing labels count as normal unless ``labelled_only``.
    """
    train, test = features.where("split = 'train'"), features.where("split = 'test'")
    require_rows(train, "training features")
    ids = ["entity_id", "window_start"]
    model, _ = forest.fit_forest(
        train,
        windows.MODEL_FEATURES,
        ids,
        config.contamination,
        config.n_trees,
        config.tree_sample,
        config.seed,
    )
    if path:
        store.save_forest(model, path, config)
    if labelled_only:
        test = test.where("anomaly_label is not null")
    if test.where("anomaly_label is not null").isEmpty():
        log.warning("no labels in the test features: detector not evaluated")
        return model, None
    return model, evaluate_detector(test, model)


def evaluate_detector(test: DataFrame, model: forest.ForestModel) -> DataFrame:
    scored = evaluate.flag_anomalies(forest.score_rows(test, model))
    table = scored.select(
        "anomaly_score", binary_label(F.col("anomaly_label")).alias("label"), F.col("anomaly_prediction").alias("flag")
    )
    return evaluate.evaluation(freeze(table, "evaluated"))


@dataclass
class Forecaster:
    known: DataFrame
    seasonal: DataFrame
    arima: DataFrame | None
    by: list[str]

    def forecast(self, steps: int, width: float = 0.90, widen: bool = False) -> DataFrame:
        grid = forecast.extend_grid(self.known, steps, self.by)
        return forecast.ensemble_forecast(grid, self.seasonal, self.arima, self.by, width, widen)


def run_forecast_training(
    prepared: Prepared,
    config: PipelineConfig = PipelineConfig(),
    path: str | None = None,
    by: list[str] | None = None,
    align: str = "time",
) -> tuple[Forecaster, DataFrame, DataFrame]:
    """Fit on the train rows of all series, forecast, and compare with the test rows."""
    by = list(config.forecast_by if by is None else by)
    train, test = prepared.rows.where("split = 'train'"), prepared.rows.where("split = 'test'")
    known = freeze(forecast.known_times(train, by), "known")
    seasonal = freeze(forecast.train_seasonal(train, by), "seasonal")
    require_rows(seasonal, "seasonal models")
    arima = freeze(forecast.train_arima(train, by, forecast.hours_for(config.forecast_steps)), "arima")
    fitted = Forecaster(known, seasonal, None if arima.isEmpty() else arima, by)
    if path:
        store.save_forecaster(path, known, seasonal, fitted.arima, by, config)
    table = fitted.forecast(config.forecast_steps, config.interval_width, config.interval_widens)
    metrics = forecast.forecast_metrics(forecast.aligned(test, table, align, by), by)
    return fitted, table, metrics


@dataclass
class PipelineResult:
    prepared: Prepared
    features: DataFrame
    model: forest.ForestModel
    detector_metrics: DataFrame | None
    forecast: DataFrame | None
    forecast_metrics: DataFrame | None
    duration_seconds: float


def run_pipeline(
    spark: SparkSession, source: str, output: str, config: PipelineConfig = PipelineConfig(), fmt: str = "csv"
) -> PipelineResult:
    """Raw readings to stored features and models. A failing forecast does not fail the run."""
    started = time.monotonic()
    prepared = run_preprocessing(read_readings(spark, source, fmt), config, path=f"{output}/processed_data")
    features = run_feature_extraction(prepared, f"{output}/features", config)
    model, metrics = run_detector_training(features, config, f"{output}/models/detector")
    table = errors = None
    try:
        _, table, errors = run_forecast_training(prepared, config, f"{output}/models/forecasting")
    except Exception:
        log.warning("forecast training failed, the run goes on", exc_info=True)
    return PipelineResult(prepared, features, model, metrics, table, errors, time.monotonic() - started)


def score_new_data(readings: DataFrame, model: forest.ForestModel, config: PipelineConfig = PipelineConfig()) -> DataFrame:
    """Predictions for new readings: nulls are imputed, short series skipped."""
    arranged = quality.arrange_readings(readings)
    filled = number(impute.impute(arranged, config.imputation), ["entity_id"])
    table = windows.extract_features(filled, ["entity_id"], config.window_size, config.step, rn="rn")
    return evaluate.predictions(freeze(forest.score_rows(table, model), "scored"))


def run_inference(
    spark: SparkSession,
    source: str,
    models: str,
    output: str | None = None,
    config: PipelineConfig | None = None,
    fmt: str = "csv",
) -> tuple[DataFrame, DataFrame | None]:
    """Score new readings with stored models and continue the stored forecast.

    Without ``config`` the settings stored with the detector hold; a given one must agree with them
    where scores depend on it, and may change the rest, such as the steps to forecast. The detector is
    required; without a forecaster, or with fewer than 2 usable new readings, there is no forecast.
    A forecaster trained by key gives rows by key.
    """
    model = store.load_forest(spark, f"{models}/detector")
    trained = store.load_config(spark, f"{models}/detector")
    if config and trained and (differing := config.conflicts(trained)):
        raise InputError(f"the detector was trained with other settings: {', '.join(differing)}")
    config = config or trained or PipelineConfig()
    readings = check_times(freeze(read_readings(spark, source, fmt, global_if_missing=True), "readings"))
    found = score_new_data(readings, model, config)
    require_rows(found, "scored windows")
    stored = store.load_forecaster(spark, f"{models}/forecasting")
    table = None
    if stored and len(forecast.usable_points(readings).take(forecast.MIN_POINTS)) == forecast.MIN_POINTS:
        table = continue_forecast(*stored, config)
    if output:
        store.write_predictions(found, output, table)
    return found, table


def continue_forecast(known: DataFrame, seasonal: DataFrame, arima: DataFrame | None, by: list[str], config: PipelineConfig) -> DataFrame:
    """The seasonal forecast over the known times and ``forecast_steps`` minutes after them."""
    grid = forecast.extend_grid(known, config.forecast_steps, by)
    return forecast.seasonal_forecast(grid, seasonal, by, config.interval_width, config.interval_widens).select(
        *by, "timestamp", F.col("seasonal_point").alias("forecast_point"), "forecast_lower", "forecast_upper"
    )


__all__ = [
    "Forecaster",
    "InputError",
    "PipelineResult",
    "Prepared",
    "continue_forecast",
    "evaluate_detector",
    "features_of",
    "part_fingerprints",
    "run_detector_training",
    "run_feature_extraction",
    "run_forecast_training",
    "run_inference",
    "run_pipeline",
    "run_preprocessing",
    "score_new_data",
]
