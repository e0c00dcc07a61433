"""Registered queries: every operator over the whole ``events`` table.

Doubles are rounded to 6 decimals, so that engines that add in another order agree.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.config import PipelineConfig
from sensorloom.functions import window_features as wf
from sensorloom.operators import (
    alerts,
    backtest,
    evaluate,
    forecast,
    forest,
    impute,
    inject,
    labels,
    quality,
    scaling,
    sketches,
    stats,
    thresholds,
    windows,
)
from sensorloom.operators import time_windows as time_window
from sensorloom.operators.ordered import number
from sensorloom.operators.quantile import exact_quantile
from sensorloom.plans import incremental, jobs
from sensorloom.session import freeze, shared_dir
from sensorloom.sources import store
from sensorloom.sources.readings import EVENT_VALUES, numeric, parse_time, read_events, read_readings, typed, with_entity
from sensorloom.streaming import live
from sensorloom.streaming import sessions as stream_sessions
from sensorloom.streaming import windows as stream_windows

MAX_GAP = 120  # minutes; suits the sparse events table
TEST_DAYS = 7
SIZE = 60
ENTITY = ["entity_id"]
SPLIT = ["entity_id", "split"]
TIMES = ["window_start", "window_end", "window_center"]
# Features of the surrogate score that stands in for the forest where SQL is the judge.
SURROGATE = ["mean_oxygen", "std_oxygen", "min_oxygen", "max_oxygen", "range", "max_roc", "mean_roc", "derivative_std"]
CONTAMINATION = 0.07
CORRELATED = [*SURROGATE, "n_points", "skewness", "kurtosis", "entropy"]
FAULT_SHARE = 0.1
LONG_STEPS = 8 * 24 * 60
BUCKET_DAYS = 4
HOT, CALM, N_OPEN, N_CLOSE, BAND = 4.5, 4.0, 3, 5, 25.0
SKETCH_FROM, SKETCH_TO = dt.date(2024, 1, 8), dt.date(2024, 1, 21)
PEAK_LEVEL, RISK = 0.95, 1e-3
NUDGE = 1e-9  # means of 64 values often end in an exact half; both engines then round it up
WINDOW_MINUTES = 360
BURST_US = 1_705_320_000_000_000  # noon of 15 January 2024
ENTITY_STEPS = 7 * 24 * 60
# Whole microseconds in minutes or hours: 10 decimals never end in an exact half.
DURATIONS = ("gap_minutes", "max_gap_minutes", "time_span_hours")
# Results of solved equations are shown on 3 decimals, in the queries where a solver made them.
SOLVER_QUERIES = (
    "seasonal_forecast",
    "arima_orders",
    "ensemble_forecast",
    "ensemble_forecast_long",
    "ensemble_forecast_by_entity",
    "forecast_evaluation",
    "forecast_training_job",
    "inference_forecast",
    "widening_interval",
    "backtest_errors",
    "baseline_choice",
    "forecast_choice",
    "chosen_forecast",
)
SOLVED = ("seasonal_point", "ensemble_point", "forecast_point", "forecast_lower", "forecast_upper", "aic", "mae", "rmse", "mape", "predicted")
# Models of the backtest that SQL can repeat, and those without a solver.
SQL_MODELS = ("seasonal", "arima", "blend", "day_before", "week_before", "mean")
BASELINES = ("day_before", "week_before", "mean")


def digits(name: str, solved: bool = False) -> int:
    return 10 if name in DURATIONS else 3 if solved and name in SOLVED else 6


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fn(spark, sf_dir), fn.__name__ in SOLVER_QUERIES)

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def rounded(df: DataFrame, solved: bool = False) -> DataFrame:
    def shown(f: T.StructField) -> str:
        if not isinstance(f.dataType, T.DoubleType):
            return f"`{f.name}`"
        return f"round(`{f.name}`, {digits(f.name, solved)}) + 0.0d as `{f.name}`"

    return df.selectExpr(*[shown(f) for f in df.schema.fields])


def _arranged(spark: SparkSession, sf_dir: str, variant: str = "plain") -> DataFrame:
    return quality.arrange_readings(read_events(spark, sf_dir, variant))


def _split(spark: SparkSession, sf_dir: str, variant: str = "plain") -> DataFrame:
    return quality.time_split(_arranged(spark, sf_dir, variant), TEST_DAYS)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _event(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(F.col("row_key").alias("event_id"), *columns)


# ---------------------------------------------------------------- sources and filters


@query
def load_profile(spark, sf_dir):
    return quality.load_profile(read_events(spark, sf_dir, "nulls"))


@query
def ts_parse(spark, sf_dir):
    """Times written as ISO with Z, with an offset, and with a space, parsed back."""
    text = F.expr(
        """case event_id % 3
             when 0 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
             when 1 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'")
             else date_format(ts, "yyyy-MM-dd HH:mm:ss") end"""
    )
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", parse_time(text).alias("time"))


@query
def numeric_coercion(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", numeric(F.expr(EVENT_VALUES["bad_text"])).alias("value")).where("value is not null")


@query
def entity_ids(spark, sf_dir):
    return quality.entities(read_events(spark, sf_dir))


@query
def null_key_entities(spark, sf_dir):
    """A missing key part reads as the text nan."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    keyed = events.select(
        F.col("event_id").alias("row_key"),
        F.col("ts").alias("time"),
        F.expr("case when user_id % 3 = 0 then null else concat('EQ', user_id % 2) end").alias("equipment"),
        F.col("event_type").alias("system"),
        "value",
    )
    return typed(keyed).groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))


@query
def missing_key_default(spark, sf_dir):
    bare = read_events(spark, sf_dir).drop("equipment", "system", "entity_id")
    return with_entity(bare, global_if_missing=True).groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))


@query
def null_filter(spark, sf_dir):
    """Nulls, NaN and infinite readings are all missing."""
    return _event(quality.clean(read_events(spark, sf_dir, "nan")), "entity_id", "value")


@query
def new_data_scan(spark, sf_dir):
    """Scoring input keeps its null readings."""
    readings = read_events(spark, sf_dir, "nulls")
    nulls = F.count_if(F.col("value").isNull()).alias("n_null")
    return readings.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"), nulls)


@query
def entity_lookup(spark, sf_dir):
    return _event(quality.entity_readings(read_events(spark, sf_dir), "EQ0_click"), "time", "value")


@query
def csv_roundtrip(spark, sf_dir):
    """Readings written as CSV with the usual headers and scanned again."""
    path = _folder(spark, "csv")
    readings = read_events(spark, sf_dir, "nulls")
    readings.select(
        F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
        F.col("equipment").alias("EquipmentUnit"),
        F.col("system").alias("System"),
        F.col("value").alias("Oxygen[%sat]"),
    ).write.mode("overwrite").option("header", True).csv(path)
    return read_readings(spark, path).select("time", "entity_id", "value")


# ---------------------------------------------------------------- quality


@query
def entity_profile(spark, sf_dir):
    return quality.entity_profile(read_events(spark, sf_dir, "nulls"))


@query
def time_delta(spark, sf_dir):
    return _event(quality.time_delta(_arranged(spark, sf_dir)), "gap_minutes")


@query
def gap_report(spark, sf_dir):
    return quality.gap_report(_arranged(spark, sf_dir), MAX_GAP)


@query
def segments(spark, sf_dir):
    return _event(quality.segments(_arranged(spark, sf_dir), MAX_GAP), "entity_id", "segment_id")


@query
def segment_counts(spark, sf_dir):
    return quality.segment_counts(quality.segments(_arranged(spark, sf_dir), MAX_GAP))


@query
def segment_stats(spark, sf_dir):
    return quality.segment_stats(quality.segments(_arranged(spark, sf_dir), MAX_GAP))


@query
def train_test_split(spark, sf_dir):
    return _event(quality.time_split(read_events(spark, sf_dir), TEST_DAYS), "entity_id", "split")


@query
def split_report(spark, sf_dir):
    return quality.split_report(quality.time_split(read_events(spark, sf_dir), TEST_DAYS))


# ---------------------------------------------------------------- imputation


@query
def forward_fill(spark, sf_dir):
    return _event(impute.forward_fill(_arranged(spark, sf_dir, "nulls")), "entity_id", "value")


@query
def impute_knn(spark, sf_dir):
    return _event(impute.neighbour_mean(read_events(spark, sf_dir, "nulls")), "entity_id", "value")


@query
def impute_ensemble(spark, sf_dir):
    return _event(impute.ensemble(read_events(spark, sf_dir, "nulls")), "entity_id", "value")


@query
def impute_spline(spark, sf_dir):
    return _event(impute.spline(_arranged(spark, sf_dir, "nulls")), "entity_id", "value")


@query
def impute_knn_time(spark, sf_dir):
    """Mean of the five readings nearest in time."""
    return _event(impute.nearest_in_time(_arranged(spark, sf_dir, "nulls")), "entity_id", "value")


@query
def missing_counts(spark, sf_dir):
    before = _arranged(spark, sf_dir, "nulls")
    return impute.missing_counts(before, impute.forward_fill(before))


# ---------------------------------------------------------------- windows and features


def _features(arranged: DataFrame, keys: list[str], names) -> DataFrame:
    return windows.extract_features(arranged, keys, SIZE, 1, list(names)).drop("window_end", "window_center")


@query
def rolling_means(spark, sf_dir):
    return _event(windows.rolling_means(_arranged(spark, sf_dir), ENTITY), "rolling_5", "rolling_10")


def _in_time(readings: DataFrame) -> DataFrame:
    found = time_window.time_windows(readings, ENTITY, WINDOW_MINUTES)
    return found.withColumn("mean", F.col("mean") + NUDGE)


@query
def time_windows(spark, sf_dir):
    """Statistics of the hours before each reading."""
    return _in_time(read_events(spark, sf_dir, "nulls"))


@query
def time_windows_burst(spark, sf_dir):
    """The same while a third of all readings fall into one minute."""
    squeezed = F.when(F.col("row_key") % 3 == 0, F.timestamp_micros(F.lit(BURST_US) + F.col("row_key") * 500)).otherwise(F.col("time"))
    return _in_time(read_events(spark, sf_dir, "nulls").withColumn("time", squeezed))


@query
def series_lengths(spark, sf_dir):
    return windows.long_enough(_split(spark, sf_dir), SPLIT, SIZE)


@query
def window_counts(spark, sf_dir):
    """Null readings left in place: windows that hold one are skipped."""
    found = windows.sliding_windows(_arranged(spark, sf_dir, "nulls"), ENTITY, SIZE)
    return windows.window_counts(found, ENTITY, SIZE)


@query
def window_meta(spark, sf_dir):
    names = ["n_points", "mean_oxygen", "std_oxygen", "min_oxygen", "max_oxygen"]
    return windows.extract_features(_split(spark, sf_dir), SPLIT, SIZE, 1, names)


@query
def window_step(spark, sf_dir):
    """Every seventh window."""
    return windows.extract_features(_arranged(spark, sf_dir), ENTITY, SIZE, 7, ["n_points", "mean_oxygen"])


@query
def segment_windows(spark, sf_dir):
    """Short windows that do not cross gaps."""
    cut = quality.segments(_arranged(spark, sf_dir), MAX_GAP)
    keys = windows.series_keys(cut, respect_segments=True)
    return windows.extract_features(cut, keys, 10, 5, ["n_points", "mean_oxygen", "median"])


@query
def point_features(spark, sf_dir):
    return _features(_arranged(spark, sf_dir, "stuck"), ENTITY, wf.POINT)


@query
def collective_features(spark, sf_dir):
    return _features(_arranged(spark, sf_dir, "stuck"), ENTITY, wf.COLLECTIVE)


@query
def contextual_features(spark, sf_dir):
    return _features(_arranged(spark, sf_dir, "stuck"), ENTITY, wf.CONTEXTUAL)


@query
def fault_features(spark, sf_dir):
    return _features(_arranged(spark, sf_dir, "stuck"), ENTITY, wf.FAULT)


@query
def distribution_features(spark, sf_dir):
    return _features(_arranged(spark, sf_dir, "stuck"), ENTITY, wf.DISTRIBUTION)


@query
def all_features(spark, sf_dir):
    return windows.extract_features(_arranged(spark, sf_dir), ENTITY, SIZE)


@query
def split_features(spark, sf_dir):
    return windows.extract_features(_split(spark, sf_dir), SPLIT, SIZE)


@query
def outlier_windows(spark, sf_dir):
    """Windows with a reading more than 3 deviations off (flagship)."""
    names = ["mean_oxygen", "std_oxygen", "percentile_25", "median", "max_roc", "autocorr_lag1", "trend_strength"]
    found = windows.extract_features(_arranged(spark, sf_dir), ENTITY, SIZE, 1, [*names, "max_zscore"])
    return found.where(F.round("max_zscore", 9) > 3)


@query
def new_data_features(spark, sf_dir):
    """Scoring path: nulls imputed over the whole series, then windows."""
    filled = impute.impute(_arranged(spark, sf_dir, "nulls"), "ensemble")
    return windows.extract_features(filled, ENTITY, SIZE, 1, ["n_points", "mean_oxygen", "std_oxygen", "median", "max_roc"])


@query
def feature_stats(spark, sf_dir):
    table = windows.extract_features(_arranged(spark, sf_dir), ENTITY, SIZE)
    return stats.feature_statistics(table)


@query
def top_features(spark, sf_dir):
    table = windows.extract_features(_arranged(spark, sf_dir), ENTITY, SIZE)
    return stats.top_features(rounded(stats.feature_statistics(table))).select("feature", "std")


@query
def feature_corr(spark, sf_dir):
    table = freeze(windows.extract_features(_arranged(spark, sf_dir), ENTITY, SIZE, 1, CORRELATED), "features")
    return stats.feature_correlation(table, CORRELATED)


# ---------------------------------------------------------------- sketches


def _stored_sketches(spark: SparkSession, readings: DataFrame) -> DataFrame:
    path = _folder(spark, "sketches")
    of = {"n_values": F.col("value"), "n_systems": F.col("system")}
    sketches.write_sketches(sketches.daily_sketches(readings, ["entity_id", "equipment"], of), path)
    return sketches.read_sketches(spark, path, SKETCH_FROM, SKETCH_TO)


@query
def sketch_profile(spark, sf_dir):
    """Distinct counts and quantiles of a fortnight from stored days, judged by the exact ones: is the error in its bound?"""
    readings, levels = read_events(spark, sf_dir, "nan"), {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    merged = sketches.merge_sketches(_stored_sketches(spark, readings), ENTITY, ["n_values"])
    told = sketches.estimates(merged, ENTITY, ["n_values"], levels).withColumnRenamed("n", "n_records")
    inside = readings.where(F.to_date("time").between(F.lit(SKETCH_FROM), F.lit(SKETCH_TO)) & F.col("value").isNotNull())
    ranks = []
    for name in levels:
        ranks += [F.avg((F.col("value") < F.col(name)).cast("int")).alias(f"{name}_from"), F.avg((F.col("value") <= F.col(name)).cast("int")).alias(f"{name}_to")]
    exact = inside.join(freeze(told, "told"), ENTITY).groupBy(*ENTITY, "n_records", F.col("n_values").alias("guess")).agg(F.count_distinct("value").alias("n_values"), *ranks)
    # Sketches draw lots: twice the 99 % error, about five standard errors, is what no run leaves.
    bound = 2 * sketches.RANK_ERROR
    near = [((F.col(f"{c}_from") <= p + bound) & (F.col(f"{c}_to") >= p - bound)).alias(f"{c}_near") for c, p in levels.items()]
    apart = F.abs(F.col("guess") - F.col("n_values")) <= 4 * sketches.DISTINCT_ERROR * F.col("n_values") + 1
    return exact.select(*ENTITY, "n_records", apart.alias("distinct_near"), *near)


@query
def sketch_rollup(spark, sf_dir):
    """The same stored days merged over the series of an equipment; the few systems are counted exactly."""
    days = _stored_sketches(spark, read_events(spark, sf_dir, "nan"))
    merged = sketches.merge_sketches(days, ["equipment"], ["n_systems"])
    return sketches.estimates(merged, ["equipment"], ["n_systems"], {}).withColumnRenamed("n", "n_records")


# ---------------------------------------------------------------- thresholds of each series


@query
def series_quantiles(spark, sf_dir):
    return thresholds.series_quantile(read_events(spark, sf_dir, "nulls"), ENTITY, "value", PEAK_LEVEL)


@query
def peak_thresholds(spark, sf_dir):
    """Levels that a series exceeds once in a thousand readings, from a fit of its peaks."""
    return thresholds.peak_thresholds(read_events(spark, sf_dir, "nulls"), ENTITY, "value", PEAK_LEVEL, RISK)


@query
def peak_alerts(spark, sf_dir):
    """Readings below the lower alert level of their series."""
    readings = read_events(spark, sf_dir, "nulls")
    levels = thresholds.peak_thresholds(readings, ENTITY, "value", 0.9, RISK, "lower")
    flagged = thresholds.flag_peaks(readings, levels, ENTITY, "value", "lower")
    return _event(flagged.where("is_alert"), "entity_id", "value")


@query
def alert_episodes(spark, sf_dir):
    """Alert episodes of the test windows, from their largest score and a stand-in forecast's interval."""
    table = windows.extract_features(_split(spark, sf_dir), SPLIT, SIZE, 1, ["max_zscore", "mean_oxygen"]).where("split = 'test'")
    scored = table.withColumn("score", F.round("max_zscore", 6))
    forecast = _stand_in_forecast(spark, sf_dir).select(
        "timestamp", (F.col("forecast_point") - BAND).alias("forecast_lower"), (F.col("forecast_point") + BAND).alias("forecast_upper")
    )
    return alerts.alert_episodes(scored, ENTITY, "score", HOT, CALM, N_OPEN, N_CLOSE, forecast, order=["window_start", "window_end", "window_center"])


# ---------------------------------------------------------------- streams

STREAM_PARTS = 6


def _streamed(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The events as files that arrive in order of time (a sixth of the period after the other), and then the end."""
    readings = read_events(spark, sf_dir).select("row_key", "time", "entity_id", "value")
    first, last = readings.agg(F.min("time"), F.max("time")).first()
    folder = _folder(spark, "arriving")
    for i in range(STREAM_PARTS):
        low, high = (first + (last - first) * j / STREAM_PARTS for j in (i, i + 1))
        inside = (F.col("time") >= F.lit(low)) & ((F.col("time") < F.lit(high)) | F.lit(i + 1 == STREAM_PARTS))
        readings.where(inside).repartition(2, "row_key").write.mode("append").parquet(folder)
    live.end_stream(spark, folder, last + dt.timedelta(days=1))
    return folder, live.open_readings(spark, folder, files_per_trigger=4)


@query
def stream_features(spark, sf_dir):
    """Window features of a stream of files, in several batches."""
    _, readings = _streamed(spark, sf_dir)
    found = stream_windows.stream_features(readings, SIZE)
    path = _folder(spark, "stream")
    live.run_available(found, path, _folder(spark, "offsets"))
    return live.results(spark, path, found)


@query
def stream_segment_stats(spark, sf_dir):
    """Gap segments closed by a stream of files, numbered."""
    _, readings = _streamed(spark, sf_dir)
    found = stream_sessions.stream_segments(readings, MAX_GAP)
    path = _folder(spark, "stream")
    live.run_available(found, path, _folder(spark, "offsets"))
    return stream_sessions.numbered(live.results(spark, path, found))


# ---------------------------------------------------------------- injection and labels


def _picked(spark, sf_dir, entity: str | None = None) -> DataFrame:
    rows = _split(spark, sf_dir)
    return inject.pick_events(rows, entity or inject.default_entity(rows), FAULT_SHARE)


@query
def inject_events(spark, sf_dir):
    return inject.injection_log(_picked(spark, sf_dir))


@query
def inject_rows(spark, sf_dir):
    rows = inject.inject_events(freeze(_picked(spark, sf_dir), "picked"))
    return _event(rows, "rn", "value", "original_value", "anomaly_label")


@query
def inject_counts(spark, sf_dir):
    return inject.injection_counts(_picked(spark, sf_dir))


@query
def uncovered_events(spark, sf_dir):
    kept = inject.without_covered_events(freeze(_picked(spark, sf_dir), "picked"))
    return _event(kept.where("event_no is not null"), "event_no", "rn", "type")


@query
def greedy_events(spark, sf_dir):
    """Fault starts that no kept fault of a lower number covers."""
    kept = inject.without_overlaps(freeze(_picked(spark, sf_dir), "picked"))
    return _event(kept.where("event_no is not null"), "event_no", "rn", "type")


@query
def nearest_label(spark, sf_dir):
    """Each reading of one unit takes the label of the other unit's reading closest in time."""
    events = read_events(spark, sf_dir)
    points = events.where("equipment = 'EQ1'").select(F.col("row_key").alias("event_id"), "system", F.col("time").alias("at"))
    seen = events.where("equipment = 'EQ0'").withColumn("label", (F.col("row_key") % 2).cast("int"))
    return labels.nearest_label(points, seen, ["system"], "at", "label").select("event_id", "label")


@query
def window_labels(spark, sf_dir):
    rows = freeze(inject.inject_events(freeze(_picked(spark, sf_dir), "picked")), "faulty")
    table = windows.extract_features(rows, SPLIT, SIZE, 1, ["mean_oxygen"], rn="rn")
    labelled = labels.center_label(table, rows, SPLIT)
    return labelled.withColumn("label", labels.binary_label(F.col("anomaly_label")))


@query
def union_batches(spark, sf_dir):
    """Train windows without labels and labelled test windows in one table."""
    train = windows.extract_features(_split(spark, sf_dir).where("split = 'train'"), SPLIT, SIZE, 1, ["mean_oxygen"])
    rows = freeze(inject.inject_events(freeze(_picked(spark, sf_dir), "picked")), "faulty")
    test = windows.extract_features(rows, SPLIT, SIZE, 1, ["mean_oxygen"], rn="rn")
    table = store.combine(train, labels.center_label(test, rows, SPLIT))
    label = labels.binary_label(F.col("anomaly_label"))
    return table.groupBy(*SPLIT).agg(
        F.count(F.lit(1)).alias("n_windows"), F.count("anomaly_label").alias("n_labelled"), F.sum(label).alias("n_positive")
    )


# ---------------------------------------------------------------- scaling, scores, evaluation


@query
def scaler_fit(spark, sf_dir):
    table = windows.extract_features(_arranged(spark, sf_dir, "stuck"), ENTITY, SIZE)
    return scaling.fit_scaler(table, windows.MODEL_FEATURES)


def _scaled(spark, sf_dir) -> DataFrame:
    """Surrogate features of all windows, scaled by the train windows."""
    table = freeze(windows.extract_features(_split(spark, sf_dir), SPLIT, SIZE, 1, SURROGATE), "features")
    fitted = scaling.fit_scaler(table.where("split = 'train'"), SURROGATE)
    return scaling.scale(table, SURROGATE, scaling.scaler_values(fitted))


@query
def scaled_features(spark, sf_dir):
    return _scaled(spark, sf_dir).where("split = 'test'").drop("window_end", "window_center")


def _raw_scores(spark, sf_dir) -> DataFrame:
    total = F.lit(0.0)
    for c in SURROGATE:
        total = total + F.abs(F.col(c))
    table = _scaled(spark, sf_dir).withColumn("raw", F.round(-total / len(SURROGATE), 9))
    return freeze(table.select(*SPLIT, *TIMES, "raw"), "raw")


@query
def surrogate_threshold(spark, sf_dir):
    raw = _raw_scores(spark, sf_dir)
    train = raw.where("split = 'train'")
    offset = exact_quantile(train, "raw", CONTAMINATION)
    return train.agg(F.lit(offset).alias("offset"), F.count_if(F.col("raw") < offset).alias("n_below"))


def _scored(spark, sf_dir) -> DataFrame:
    raw = _raw_scores(spark, sf_dir)
    offset = exact_quantile(raw.where("split = 'train'"), "raw", CONTAMINATION)
    score = F.round(F.col("raw") - F.lit(offset), 9) + F.lit(0.0)
    return raw.where("split = 'test'").withColumn("anomaly_score", score).drop("raw")


def _labelled(spark, sf_dir) -> DataFrame:
    flagged = evaluate.flag_anomalies(_scored(spark, sf_dir))
    is_error: Column = F.col("entity_id").endswith("_error")
    return flagged.select(
        "*", is_error.cast("int").alias("label"), F.col("anomaly_prediction").alias("flag")
    )


@query
def anomaly_predictions(spark, sf_dir):
    return evaluate.predictions(_scored(spark, sf_dir))


@query
def detection_summary(spark, sf_dir):
    return evaluate.detection_summary(evaluate.flag_anomalies(_scored(spark, sf_dir)))


@query
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion(_labelled(spark, sf_dir))


@query
def precision_recall(spark, sf_dir):
    return evaluate.precision_recall(evaluate.confusion(_labelled(spark, sf_dir))).select("precision", "recall", "f1")


@query
def roc_auc(spark, sf_dir):
    return evaluate.roc_auc(_labelled(spark, sf_dir))


@query
def roc_points(spark, sf_dir):
    return evaluate.roc_points(_labelled(spark, sf_dir))


@query
def evaluation(spark, sf_dir):
    return evaluate.evaluation(_labelled(spark, sf_dir))


@query
def score_histogram(spark, sf_dir):
    return evaluate.histogram(evaluate.flag_anomalies(_scored(spark, sf_dir)), "anomaly_score", "anomaly_prediction", 50)


@query
def severity_histogram(spark, sf_dir):
    return evaluate.histogram(evaluate.predictions(_scored(spark, sf_dir)), "severity_score", "anomaly_prediction", 30)


@query
def run_summary(spark, sf_dir):
    rows = _split(spark, sf_dir)
    table = windows.extract_features(rows, SPLIT, SIZE, 1, ["n_points"])
    return evaluate.run_summary(table, rows)


@query
def forest_scores(spark, sf_dir):
    """Isolation forest on the train windows, predictions for the test windows."""
    table = freeze(windows.extract_features(_split(spark, sf_dir), SPLIT, SIZE), "features")
    model, _ = forest.fit_forest(table.where("split = 'train'"), windows.MODEL_FEATURES, ["entity_id", "window_start"])
    scored = forest.score_rows(table.where("split = 'test'"), model)
    return evaluate.predictions(freeze(scored, "scored"))


@query
def forest_training_summary(spark, sf_dir):
    table = freeze(windows.extract_features(_split(spark, sf_dir), SPLIT, SIZE), "features")
    _, train = forest.fit_forest(table.where("split = 'train'"), windows.MODEL_FEATURES, ["entity_id", "window_start"])
    return evaluate.detection_summary(evaluate.flag_anomalies(train))


# ---------------------------------------------------------------- stores


@query
def feature_cache(spark, sf_dir):
    """Which series have stored train features after storing those of one unit."""
    path = _folder(spark, "store")
    rows = _split(spark, sf_dir).where("entity_id like 'EQ0%'")
    store.write_features(windows.extract_features(rows, SPLIT, SIZE, 1, ["mean_oxygen"]), path)
    missing, existing = store.check_features(spark, path, quality.entities(read_events(spark, sf_dir)))
    return missing.withColumn("status", F.lit("missing")).unionByName(existing.withColumn("status", F.lit("existing")))


@query
def feature_store(spark, sf_dir):
    """Features written to the store and read back for one split."""
    path = _folder(spark, "roundtrip")
    store.write_features(windows.extract_features(_split(spark, sf_dir), SPLIT, SIZE, 1, ["mean_oxygen", "median"]), path)
    stored = store.read_features(spark, path, "test")
    return stored.select("entity_id", "split", "window_start", "mean_oxygen", "median")


@query
def stored_entities(spark, sf_dir):
    path = _folder(spark, "listing")
    store.write_features(windows.extract_features(_split(spark, sf_dir), SPLIT, SIZE, 1, ["mean_oxygen"]), path)
    return store.stored_entities(spark, path)


@query
def prediction_store(spark, sf_dir):
    """Predictions written as CSV and counted again."""
    path = _folder(spark, "predictions")
    store.write_predictions(evaluate.predictions(_scored(spark, sf_dir)), path)
    schema = "entity_id string, window_start timestamp, window_center timestamp, window_end timestamp, "
    schema += "anomaly_prediction int, anomaly_score double, is_anomaly boolean, severity_score int, severity_high_is_bad int"
    back = spark.read.schema(schema).option("header", True).csv(f"{path}/anomaly_predictions")
    return back.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_anomaly").alias("n_anomalies"), F.max("severity_score").alias("max_severity")
    )


# ---------------------------------------------------------------- forecasting


def _train(spark, sf_dir) -> DataFrame:
    return quality.time_split(read_events(spark, sf_dir), TEST_DAYS).where("split = 'train'")


def _test(spark, sf_dir) -> DataFrame:
    return quality.time_split(read_events(spark, sf_dir), TEST_DAYS).where("split = 'test'")


@query
def hourly_resample(spark, sf_dir):
    return forecast.hourly_mean(read_events(spark, sf_dir, "nulls"))


@query
def hourly_resample_by_entity(spark, sf_dir):
    return forecast.hourly_mean(read_events(spark, sf_dir, "nulls"), ENTITY)


@query
def future_grid(spark, sf_dir):
    grid = forecast.future_grid(_train(spark, sf_dir), 7 * 24 * 60)
    return grid.withColumn("step", F.coalesce("step", F.lit(0)))


def _hour_table(train: DataFrame) -> DataFrame:
    """Mean per hour of the day as stand-in hourly forecast h = 0 .. 23."""
    return train.groupBy(F.hour("time").alias("h")).agg(F.avg("value").alias("hourly_value"))


@query
def step_hold_blend(spark, sf_dir):
    train = _train(spark, sf_dir)
    grid = forecast.future_grid(train, 7 * 24 * 60).where("step is not null")
    minutes = grid.withColumn("seasonal_point", F.lit(50.0) + F.minute("timestamp"))
    return forecast.step_hold_blend(minutes, _hour_table(train)).select("step", "timestamp", "ensemble_point")


def _stand_in_forecast(spark, sf_dir) -> DataFrame:
    grid = forecast.future_grid(_train(spark, sf_dir), 7 * 24 * 60)
    return grid.withColumn("forecast_point", F.lit(50.0) + F.minute("timestamp"))


@query
def forecast_metrics(spark, sf_dir):
    return forecast.forecast_metrics(forecast.aligned(_test(spark, sf_dir), _stand_in_forecast(spark, sf_dir)))


@query
def forecast_metrics_by_position(spark, sf_dir):
    pairs = forecast.aligned(_test(spark, sf_dir), _stand_in_forecast(spark, sf_dir), "position")
    return forecast.forecast_metrics(pairs)


@query
def forecast_head(spark, sf_dir):
    """As many forecast rows as there are test rows, from the start of the grid."""
    n = _test(spark, sf_dir).count()
    return forecast.forecast_head(_stand_in_forecast(spark, sf_dir).drop("step"), n)


@query
def forecast_moments(spark, sf_dir):
    return forecast.moments(_train(spark, sf_dir))


@query
def seasonal_forecast(spark, sf_dir):
    train = _train(spark, sf_dir)
    model = freeze(forecast.train_seasonal(train), "seasonal")
    table = forecast.seasonal_forecast(forecast.future_grid(train, 7 * 24 * 60), model)
    return table.withColumn("step", F.coalesce("step", F.lit(0)))


@query
def arima_orders(spark, sf_dir):
    return forecast.arima_orders(_train(spark, sf_dir)).select("p", "d", "q", "n_hours", "aic")


@query
def ensemble_forecast(spark, sf_dir):
    table = forecast.forecast_ensemble(_train(spark, sf_dir), 7 * 24 * 60)
    return table.withColumn("step", F.coalesce("step", F.lit(0)))


@query
def ensemble_forecast_long(spark, sf_dir):
    """Eight days ahead: the hourly part reaches as far as the steps do."""
    table = forecast.forecast_ensemble(_train(spark, sf_dir), LONG_STEPS)
    return table.where("step is not null")


@query
def ensemble_forecast_by_entity(spark, sf_dir):
    table = forecast.forecast_ensemble(_train(spark, sf_dir), ENTITY_STEPS, ENTITY)
    return table.withColumn("step", F.coalesce("step", F.lit(0)))


@query
def forecast_evaluation(spark, sf_dir):
    table = forecast.forecast_ensemble(_train(spark, sf_dir), 7 * 24 * 60)
    return forecast.forecast_metrics(forecast.aligned(_test(spark, sf_dir), table))


@query
def widening_interval(spark, sf_dir):
    """The seasonal forecast of a week with an interval that grows by the changes of trend to be expected."""
    train = _train(spark, sf_dir)
    model = freeze(forecast.train_seasonal(train), "seasonal")
    table = forecast.seasonal_forecast(forecast.future_grid(train, 7 * 24 * 60), model, widen=True)
    return table.withColumn("step", F.coalesce("step", F.lit(0)))


@query
def backtest_errors(spark, sf_dir):
    """Errors of the models over three origins, all series pooled."""
    return backtest.errors(backtest.backtest(read_events(spark, sf_dir), models=SQL_MODELS))


@query
def baseline_choice(spark, sf_dir):
    """For each series the best of the models that only look up known hours."""
    pairs = backtest.backtest(read_events(spark, sf_dir), ENTITY, BASELINES)
    return backtest.choose(backtest.errors(pairs, ENTITY), ENTITY)


@query
def forecast_choice(spark, sf_dir):
    """For each series the best of all models, the trees among them."""
    pairs = backtest.backtest(read_events(spark, sf_dir), ENTITY)
    return backtest.choose(backtest.errors(pairs, ENTITY), ENTITY)


@query
def chosen_forecast(spark, sf_dir):
    """The next day of each series by the model that was best for it."""
    readings = read_events(spark, sf_dir)
    choice = freeze(backtest.choose(backtest.errors(backtest.backtest(readings, ENTITY), ENTITY), ENTITY), "choice")
    return backtest.forecast_chosen(readings, choice, ENTITY)


# ---------------------------------------------------------------- jobs


def _config() -> PipelineConfig:
    return PipelineConfig(max_gap_minutes=MAX_GAP)


@query
def preprocessing_job(spark, sf_dir):
    """Clean, segment, split, inject: rows per series and part with their labels."""
    done = jobs.run_preprocessing(read_events(spark, sf_dir, "nulls"), _config())
    return done.rows.groupBy(*SPLIT).agg(
        F.count(F.lit(1)).alias("n"), F.max("segment_id").alias("last_segment"), F.count_if(F.col("anomaly_label") == 1).alias("n_labelled")
    )


@query
def training_job(spark, sf_dir):
    """Preprocessing, features, detector: evaluation on the injected faults."""
    done = jobs.run_preprocessing(read_events(spark, sf_dir), _config())
    table = freeze(jobs.features_of(done.rows, _config()), "features")
    model, metrics = jobs.run_detector_training(table, _config())
    return metrics or jobs.evaluate_detector(table.where("split = 'test'"), model)


@query
def inference_job(spark, sf_dir):
    """Detector trained on the train windows, scoring readings with nulls."""
    table = freeze(windows.extract_features(_split(spark, sf_dir), SPLIT, SIZE), "features")
    model, _ = forest.fit_forest(table.where("split = 'train'"), windows.MODEL_FEATURES, ["entity_id", "window_start"])
    return jobs.score_new_data(read_events(spark, sf_dir, "nulls"), model, _config())


def _without_faults(spark, sf_dir) -> jobs.Prepared:
    return jobs.run_preprocessing(read_events(spark, sf_dir), _config(), create_faults=False)


@query
def clean_store(spark, sf_dir):
    """Segmented rows written by series and read back."""
    path = _folder(spark, "clean")
    jobs.run_preprocessing(read_events(spark, sf_dir, "nan"), _config(), create_faults=False, path=path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("entity_id").cast("string").alias("entity_id")).agg(
        F.count(F.lit(1)).alias("n"), F.min("time").alias("start_time"), F.max("time").alias("end_time"), F.max("segment_id").alias("last_segment")
    )


@query
def model_roundtrip(spark, sf_dir):
    """A detector stored and loaded again scores the test windows."""
    path = _folder(spark, "models")
    table = freeze(windows.extract_features(_split(spark, sf_dir), SPLIT, SIZE), "features")
    unlabelled = table.withColumn("anomaly_label", F.lit(None).cast("int"))
    jobs.run_detector_training(unlabelled, _config(), path)
    scored = forest.score_rows(table.where("split = 'test'"), store.load_forest(spark, path))
    return evaluate.predictions(freeze(scored, "scored"))


@query
def feature_job(spark, sf_dir):
    """Features stored by a first run, one series lost, and completed by a second run."""
    path, config = _folder(spark, "features"), _config()
    prepared = _without_faults(spark, sf_dir)
    lost = jobs.Prepared(prepared.rows.where("entity_id != 'EQ0_click'"), None, None)
    jobs.run_feature_extraction(lost, path, config)
    jobs.run_feature_extraction(prepared, path, config)
    stored = jobs.run_feature_extraction(prepared, path, config)
    return stored.groupBy(*SPLIT).agg(F.count(F.lit(1)).alias("n_windows"), F.avg("median").alias("mean_median"))


@query
def incremental_features(spark, sf_dir):
    """Features stored without the last day, then brought up to date with it."""
    path, readings = _folder(spark, "blocks"), read_events(spark, sf_dir)
    end = readings.agg(F.max("time")).first()[0]
    for known in (readings.where(F.col("time") < F.lit(end - dt.timedelta(days=1))), readings):
        split = quality.time_split(quality.arrange_readings(known), TEST_DAYS)
        prepared = jobs.Prepared(freeze(number(split, SPLIT), "prepared"), None, None)
        update = incremental.update_features(prepared, path, _config(), BUCKET_DAYS)
    return update.features.drop("anomaly_label")


@query
def forecast_training_job(spark, sf_dir):
    _, _, metrics = jobs.run_forecast_training(_without_faults(spark, sf_dir), _config(), _folder(spark, "forecaster"))
    return metrics


@query
def inference_forecast(spark, sf_dir):
    """Forecasters of each series, stored, loaded, and continued over a horizon of their own."""
    path = _folder(spark, "forecasters")
    jobs.run_forecast_training(_without_faults(spark, sf_dir), _config(), path, ENTITY)
    ahead = PipelineConfig(forecast_steps=ENTITY_STEPS)
    table = jobs.continue_forecast(*store.load_forecaster(spark, path), ahead)
    return table.withColumnRenamed("forecast_point", "seasonal_point")


@query
def pipeline_job(spark, sf_dir):
    """A whole run over CSV files: what it stored and forecast."""
    source, output = _folder(spark, "source"), _folder(spark, "run")
    read_events(spark, sf_dir, "nulls").select(
        F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        F.col("system").alias("system_id"),
        F.col("equipment").alias("equipment_id"),
        F.col("value").alias("oxygen_saturation"),
    ).write.option("header", True).csv(source)
    done = jobs.run_pipeline(spark, source, output, _config())
    counted = done.features.groupBy(F.col("split").alias("part")).agg(F.count(F.lit(1)).alias("n"))
    ahead = done.forecast.where("step is not null").agg(F.lit("forecast").alias("part"), F.count(F.lit(1)).alias("n"))
    faults = done.prepared.rows.agg(F.lit("labelled").alias("part"), F.count("anomaly_label").alias("n"))
    return counted.unionByName(ahead).unionByName(faults)
