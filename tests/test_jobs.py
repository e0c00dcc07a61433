"""Whole runs on a small CSV."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.config import PipelineConfig
from sensorloom.operators import forecast, quality
from sensorloom.plans import jobs
from sensorloom.sources import store
from sensorloom.sources.readings import InputError

from conftest import START

CONFIG = PipelineConfig(test_size_days=1, window_size=20, overlap=19, n_trees=20, forecast_steps=120)


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    """Two devices, one reading every 6 minutes for 4 days, some readings missing."""
    rng = np.random.default_rng(15)
    path = str(tmp_path_factory.mktemp("csv") / "readings.csv")
    with open(path, "w") as f:
        f.write("time,EquipmentUnit,System,Oxygen[%sat]\n")
        for unit, level in (("EQ1", 95.0), ("EQ2", 90.0)):
            for i in range(960):
                value = "" if i % 97 == 5 else f"{level + np.sin(i / 38) + rng.normal(0, 0.1):.3f}"
                f.write(f"{(START + dt.timedelta(minutes=6 * i)).isoformat()}Z,{unit},S,{value}\n")
    return path


@pytest.fixture(scope="module")
def run(spark, source, tmp_path_factory):
    output = str(tmp_path_factory.mktemp("out"))
    return output, jobs.run_pipeline(spark, source, output, CONFIG)


def test_pipeline(spark, run):
    output, result = run
    rows = result.prepared.rows
    assert result.prepared.entity == "EQ1_S"
    assert rows.where("value is null").count() == 0
    assert rows.where("anomaly_label is not null").select("entity_id", "split").distinct().collect() == [("EQ1_S", "test")]
    counts = {(r.entity_id, r.split): r.n for r in rows.groupBy("entity_id", "split").agg(F.count("*").alias("n")).collect()}
    features = {(r.entity_id, r.split): r.n for r in result.features.groupBy("entity_id", "split").agg(F.count("*").alias("n")).collect()}
    assert features == {k: n - 19 for k, n in counts.items()}
    assert result.prepared.injection_log.count() == counts[("EQ1_S", "test")] // 10
    m = result.detector_metrics.first()
    assert m.tn + m.fp + m.fn + m.tp == sum(n for (_, s), n in features.items() if s == "test")
    assert m.roc_auc > 0.6
    assert result.forecast_metrics.first().mae < 5
    assert spark.read.parquet(f"{output}/processed_data").count() == 2 * (960 - 10)


def test_cached_features_are_reused(run, tmp_path):
    _, result = run
    path = str(tmp_path)
    one = jobs.Prepared(result.prepared.rows.where("entity_id = 'EQ2_S'"), None, None)
    first = set(jobs.run_feature_extraction(one, path, CONFIG).inputFiles())
    both = set(jobs.run_feature_extraction(result.prepared, path, CONFIG).inputFiles())
    assert first < both
    again = jobs.run_feature_extraction(result.prepared, path, CONFIG)
    assert set(again.inputFiles()) == both
    forced = jobs.run_feature_extraction(result.prepared, path, CONFIG, force=True)
    assert not set(forced.inputFiles()) & both


def test_inference(spark, run, source, tmp_path):
    output, result = run
    found, table = jobs.run_inference(spark, source, f"{output}/models", str(tmp_path / "p"), CONFIG)
    assert found.count() == 2 * (960 - 19)
    assert set(found.columns) >= {"entity_id", "anomaly_prediction", "anomaly_score", "is_anomaly", "severity_score"}
    assert found.agg(F.min("severity_score"), F.max("severity_score")).first() == (0, 100)
    trained = result.prepared.rows.where("split = 'train'")
    last = trained.agg(F.max("time")).first()[0]
    assert table.where(F.col("timestamp") > F.lit(last)).count() == 120
    assert table.count() == 120 + trained.select("time").distinct().count()
    back = spark.read.option("header", True).csv(str(tmp_path / "p" / "anomaly_predictions"))
    assert back.count() == found.count()


def test_model_roundtrip(spark, run):
    output, result = run
    loaded = store.load_forest(spark, f"{output}/models/detector")
    assert loaded.offset == result.model.offset and loaded.names == result.model.names
    assert loaded.nodes.count() == result.model.nodes.count()
    with pytest.raises(InputError):
        store.load_forest(spark, f"{output}/nowhere")
    assert store.load_forecaster(spark, f"{output}/nowhere") is None


def test_inference_without_forecaster(spark, run, source, tmp_path):
    _, result = run
    store.save_forest(result.model, str(tmp_path / "detector"))
    found, table = jobs.run_inference(spark, source, str(tmp_path), None, CONFIG)
    assert table is None and not found.isEmpty()


def test_detector_without_labels_is_not_evaluated(run):
    _, result = run
    unlabelled = result.features.withColumn("anomaly_label", F.lit(None).cast("int"))
    model, metrics = jobs.run_detector_training(unlabelled, CONFIG)
    assert metrics is None and model.nodes.count() > 0


def test_labelled_only(run):
    _, result = run
    _, metrics = jobs.run_detector_training(result.features, CONFIG, labelled_only=True)
    m = metrics.first()
    assert m.tn + m.fp + m.fn + m.tp == result.features.where("anomaly_label is not null").count()


def test_segments_respected(run):
    _, result = run
    config = PipelineConfig(test_size_days=1, window_size=20, overlap=19, respect_segments=True)
    whole = jobs.features_of(result.prepared.rows, CONFIG).count()
    assert 0 < jobs.features_of(result.prepared.rows, config).count() < whole


def test_empty_input(spark):
    empty = spark.createDataFrame([], "row_key bigint, time timestamp, entity_id string, value double")
    with pytest.raises(InputError):
        jobs.run_preprocessing(empty)


def test_no_faults(make):
    done = jobs.run_preprocessing(make({"a": range(50)}), CONFIG, create_faults=False)
    assert done.entity is None and "anomaly_label" not in done.rows.columns


def test_forecast_per_entity(run):
    _, result = run
    fitted, table, metrics = jobs.run_forecast_training(result.prepared, CONFIG, by=["entity_id"])
    assert fitted.seasonal.count() == 2 and metrics.count() == 2
    level = {r.entity_id: r.p for r in table.where("step = 60").select("entity_id", F.col("forecast_point").alias("p")).collect()}
    assert level["EQ1_S"] > 93 > 92 > level["EQ2_S"]


def test_forecast_failure_does_not_fail_the_run(spark, source, tmp_path, monkeypatch):
    monkeypatch.setattr(forecast, "train_seasonal", lambda *a, **k: 1 / 0)
    result = jobs.run_pipeline(spark, source, str(tmp_path), CONFIG)
    assert result.forecast is None and result.detector_metrics is not None


def test_short_series_are_skipped(spark, make):
    arranged = quality.arrange_readings(make({"long": range(25), "short": range(19)}))
    from sensorloom.operators import windows

    got = windows.extract_features(arranged, ["entity_id"], 20, 1, ["mean"])
    assert [r.entity_id for r in got.select("entity_id").distinct().collect()] == ["long"]


def test_features_follow_the_rows_and_all_parts(run, tmp_path):
    _, result = run
    path, rows = str(tmp_path), result.prepared.rows
    half = jobs.Prepared(rows.where("split = 'train'"), None, None)
    jobs.run_feature_extraction(half, path, CONFIG)
    whole = jobs.run_feature_extraction(result.prepared, path, CONFIG)
    assert whole.groupBy("entity_id", "split").count().count() == 4
    moved = jobs.Prepared(rows.withColumn("value", F.when(F.col("entity_id") == "EQ2_S", F.col("value") + 1).otherwise(F.col("value"))), None, None)
    mean = lambda t: {r.entity_id: r.m for r in t.groupBy("entity_id").agg(F.avg("mean").alias("m")).collect()}
    before = mean(whole)
    after = mean(jobs.run_feature_extraction(moved, path, CONFIG))
    assert after["EQ2_S"] == pytest.approx(before["EQ2_S"] + 1) and after["EQ1_S"] == pytest.approx(before["EQ1_S"])
    shorter = jobs.Prepared(rows.where("entity_id = 'EQ2_S' and split = 'train'"), None, None)
    left = jobs.run_feature_extraction(shorter, path, CONFIG)
    assert left.where("entity_id = 'EQ2_S'").select("split").distinct().collect() == [("train",)]


def test_settings_are_stored_and_checked(spark, run, source):
    output, _ = run
    assert store.load_config(spark, f"{output}/models/detector") == CONFIG
    with pytest.raises(InputError, match="window_size"):
        jobs.run_inference(spark, source, f"{output}/models", None, PipelineConfig(window_size=30, overlap=29))
    found, table = jobs.run_inference(spark, source, f"{output}/models")
    assert found.count() == 2 * (960 - 19)
    ahead = PipelineConfig(window_size=20, overlap=19, forecast_steps=7)
    _, short = jobs.run_inference(spark, source, f"{output}/models", None, ahead)
    assert table.count() - short.count() == 120 - 7


def test_forecasts_by_entity_are_continued_by_entity(spark, run, source, tmp_path):
    _, result = run
    store.save_forest(result.model, str(tmp_path / "detector"), CONFIG)
    jobs.run_forecast_training(result.prepared, CONFIG, str(tmp_path / "forecasting"), by=["entity_id"])
    _, table = jobs.run_inference(spark, source, str(tmp_path))
    level = {r.entity_id: r.p for r in table.groupBy("entity_id").agg(F.avg("forecast_point").alias("p")).collect()}
    assert level["EQ1_S"] > 93 > 92 > level["EQ2_S"]


def test_an_older_arima_model_is_not_used(spark, run, tmp_path):
    _, result = run
    path = str(tmp_path)
    fitted, _, _ = jobs.run_forecast_training(result.prepared, CONFIG, path)
    assert store.load_forecaster(spark, path)[2] is not None
    store.save_forecaster(path, fitted.known, fitted.seasonal, None)
    assert store.load_forecaster(spark, path)[2] is None


def test_intermediates_go_to_the_named_folder(spark, make):
    from pathlib import Path

    from sensorloom.session import CHECKPOINT_DIR, shared_dir

    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    folder = shared_dir(spark)
    assert not named or folder == named.rstrip("/")
    found = lambda: {p.name for p in Path(folder.removeprefix("file:")).glob("prepared-*")}
    before = found()
    jobs.run_preprocessing(make({"a": range(50)}), CONFIG, create_faults=False)
    assert len(found() - before) == 1


def test_a_write_makes_each_window_once(spark, make, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    table = make({"a": range(50), "b": range(30)}).withColumn("split", F.lit("train")).withColumnRenamed("time", "window_start")
    store.write_features(table.mapInArrow(count, table.schema), str(tmp_path / "f"))
    assert seen.value == 80


def test_settings_have_bounds():
    for bad in ({"n_trees": 0}, {"n_trees": 10**6}, {"tree_sample": 10**6}, {"forecast_steps": 0}, {"interval_width": 1.0}):
        with pytest.raises(ValueError):
            PipelineConfig(**bad)


def test_scratch_deletes_what_was_written_inside(spark, make):
    from pathlib import Path

    from sensorloom.session import freeze, scratch

    outside = freeze(make({"a": range(3)}), "outside")
    with scratch(spark):
        inside = freeze(make({"a": range(3)}), "inside")
        files = [Path(f.removeprefix("file:").replace("///", "/")) for f in inside.inputFiles()]
        assert inside.count() == 3 and all(f.exists() for f in files)
    assert files and not any(f.exists() for f in files) and outside.count() == 3
