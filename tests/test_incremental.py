import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from sensorloom.config import PipelineConfig
from sensorloom.operators import quality
from sensorloom.operators.ordered import number
from sensorloom.plans import incremental, jobs

from conftest import START

SCHEMA = "row_key bigint, time timestamp, entity_id string, split string, value double, anomaly_label int"


def rows_of(lengths, hours=1.0, seed=0):
    rng, rows, key = np.random.default_rng(seed), [], 0
    for name, n in lengths.items():
        for m in np.cumsum(rng.exponential(hours * 60, n)):
            rows.append((key, START + dt.timedelta(minutes=round(float(m), 3)), name, "train", round(float(rng.normal(50, 5)), 3), None))
            key += 1
    return rows


def prepared(spark, rows, gap=None):
    arranged = quality.arrange_readings(spark.createDataFrame(rows, SCHEMA))
    if gap:
        arranged = quality.segments(arranged, gap)
    return jobs.Prepared(number(arranged, ["entity_id", "split"]), None, None)


def told(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def check(spark, rows, path, config, gap=None, days=2):
    """After an update the store equals a full run; returns how many windows were recomputed, and how many there are."""
    part = prepared(spark, rows, gap)
    update = incremental.update_features(part, str(path), config, days)
    full = jobs.features_of(part.rows, config)
    assert told(update.features) == told(full.select(update.features.columns))
    buckets = full.withColumn("bucket", incremental.bucket_of(F.col("window_start"), days))
    redone = buckets.join(update.recomputed, ["split", "entity_id", "bucket"], "left_semi").count()
    return redone, full.count()


@pytest.mark.parametrize("overlap", [11, 7])
def test_only_changed_blocks_are_recomputed(spark, tmp_path, overlap):
    config = PipelineConfig(window_size=12, overlap=overlap)
    rows = rows_of({"a": 300, "b": 100, "c": 11, "007": 40})
    cut = sorted(r[1] for r in rows)[-1] - dt.timedelta(days=1)
    redone, total = check(spark, [r for r in rows if r[1] < cut], tmp_path, config)
    assert redone == total > 0
    # A day more: only the last blocks of the longest series.
    redone, total = check(spark, rows, tmp_path, config)
    assert 0 < redone < total / 4
    assert check(spark, rows, tmp_path, config) == (0, total)
    # A changed value in the middle touches its block, and the one before if windows reach into it.
    changed = [(*r[:4], 1.0, r[5]) if r[0] == 150 else r for r in rows]
    redone, total = check(spark, changed, tmp_path, config)
    assert 0 < redone < total / 4


def test_a_late_and_a_lost_row(spark, tmp_path):
    rows = rows_of({"a": 300, "b": 60}, seed=1)
    config = PipelineConfig(window_size=12, overlap=11)
    check(spark, rows, tmp_path, config)
    late = [*rows, (9999, rows[100][1] + dt.timedelta(seconds=1), "a", "train", 3.0, None)]
    redone, total = check(spark, late, tmp_path, config)
    assert 0 < redone < total / 4
    redone, total = check(spark, [r for r in late if r[0] != 200], tmp_path, config)
    assert 0 < redone < total / 4
    # A series that is gone, and one whose rows all lie elsewhere now.
    moved = [(*r[:1], r[1] + dt.timedelta(days=400), *r[2:]) for r in rows if r[2] == "a"]
    redone, total = check(spark, moved, tmp_path, config)
    assert redone == total


def test_with_windows_that_do_not_cover_every_row_a_late_row_moves_the_rest(spark, tmp_path):
    rows = rows_of({"a": 300}, seed=2)
    config = PipelineConfig(window_size=12, overlap=7)
    check(spark, rows, tmp_path, config)
    late = [*rows, (9999, rows[100][1] + dt.timedelta(seconds=1), "a", "train", 3.0, None)]
    redone, total = check(spark, late, tmp_path, config)
    assert total / 2 < redone < total


def test_labels_and_segments_count(spark, tmp_path):
    rows = rows_of({"a": 200, "b": 50}, seed=3)
    rows = [(*r[:5], r[0] % 2) for r in rows]
    config = PipelineConfig(window_size=12, overlap=11, respect_segments=True)
    check(spark, rows, tmp_path, config, gap=180)
    labelled = [(*r[:5], 1) if r[0] == 120 else r for r in rows]
    redone, total = check(spark, [(*r[:5], 0) if r[0] == 121 else r for r in labelled], tmp_path, config, gap=180)
    assert 0 < redone < total / 3
    assert check(spark, rows[:5], tmp_path, config, gap=180) == (0, 0)


def test_a_run_that_died_between_blocks_is_repaired(spark, tmp_path):
    rows = rows_of({"a": 200}, seed=4)
    config = PipelineConfig(window_size=12, overlap=11)
    _, total = check(spark, rows, tmp_path, config)
    store = next(tmp_path.iterdir()) / "split=train" / "entity_id=a"
    lost = sorted(store.iterdir())[1]
    for f in lost.iterdir():
        f.unlink()
    redone, again = check(spark, rows, tmp_path, config)
    assert again == total and 0 < redone < total / 2
