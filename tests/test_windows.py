import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.config import PipelineConfig
from sensorloom.operators import quality, windows

from conftest import START


def starts(readings, size=60, step=1, keys=("entity_id",), names=("mean_oxygen",), **kw):
    arranged = quality.arrange_readings(readings, 2)
    return windows.extract_features(arranged, list(keys), size, step, list(names)).toPandas()


@pytest.mark.parametrize("rows, n", [(59, 0), (60, 1), (61, 2)])
def test_only_full_windows(make, rows, n):
    assert len(starts(make({"e": range(rows)}))) == n


def test_step(make):
    got = starts(make({"e": range(100)}), step=PipelineConfig(overlap=53).step)
    minutes = sorted((t - START).total_seconds() / 60 for t in got["window_start"])
    assert minutes == [0, 7, 14, 21, 28, 35]


def test_times_and_block_borders(make):
    """Windows cross the borders of small blocks unharmed."""
    arranged = quality.arrange_readings(make({"e": range(300)}), 3)
    found = windows.sliding_windows(arranged, ["entity_id"], 60, rows_per_block=64).toPandas()
    assert len(found) == 241
    for _, w in found.iterrows():
        first = int(w["values"][0])
        assert list(w["values"]) == list(range(first, first + 60))
        assert w["window_start"] == START + dt.timedelta(minutes=first)
        assert w["window_center"] == START + dt.timedelta(minutes=first + 30)
        assert w["window_end"] == START + dt.timedelta(minutes=first + 59)


def test_windows_with_nulls_are_skipped_and_counted(make):
    arranged = quality.arrange_readings(make({"e": [None, 1, 2, 3, 4, 5], "f": [1, 2, 3, 4, 5, 6]}))
    found = windows.sliding_windows(arranged, ["entity_id"], 4)
    counts = {r.entity_id: (r.n_total, r.n_processed, r.n_skipped) for r in windows.window_counts(found, ["entity_id"], 4).collect()}
    assert counts == {"e": (3, 2, 1), "f": (3, 3, 0)}
    assert windows.complete(found, 4).count() == 5


def test_windows_stay_inside_splits_and_segments(make):
    minutes = {"e": [*range(10), *range(100, 110)]}
    cut = quality.segments(quality.arrange_readings(make({"e": range(20)}, minutes)), 10)
    assert windows.series_keys(cut, True) == ["entity_id", "segment_id"]
    inside = windows.extract_features(cut, ["entity_id", "segment_id"], 8, 1, ["mean"]).count()
    across = windows.extract_features(cut, ["entity_id"], 8, 1, ["mean"]).count()
    assert (inside, across) == (6, 13)


def test_rolling_means(make):
    values = np.random.default_rng(4).normal(0, 1, 40)
    arranged = quality.arrange_readings(make({"e": values}))
    got = windows.rolling_means(arranged, ["entity_id"]).orderBy("row_key").toPandas()
    for i in range(40):
        five = values[i - 2 : i + 3].mean() if 2 <= i <= 37 else values[i]
        ten = values[i - 5 : i + 5].mean() if 5 <= i <= 35 else values[i]
        assert got["rolling_5"][i] == pytest.approx(five)
        assert got["rolling_10"][i] == pytest.approx(ten)


def test_long_enough(make):
    kept = windows.long_enough(make({"a": range(59), "b": range(60)}), ["entity_id"], 60).collect()
    assert [(r.entity_id, r.n_rows) for r in kept] == [("b", 60)]


def test_config_is_checked():
    for bad in ({"overlap": 60}, {"overlap": -1}, {"imputation": "magic"}, {"contamination": 0}, {"window_size": 1, "overlap": 0}):
        with pytest.raises(ValueError):
            PipelineConfig(**bad)
    assert PipelineConfig().feature_hash() != PipelineConfig(window_size=120, overlap=118).feature_hash()


def test_window_groups_are_bounded(make):
    """No operator of the feature path orders a whole series in one task."""
    arranged = quality.arrange_readings(make({"e": range(200)}), 2)
    plan = windows.extract_features(arranged, ["entity_id"], 60)._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "collect_list" in line:
            assert "_block" in line


def test_entities_and_profile(make):
    readings = make({"a": [1, None, 3], "b": [None, None]})
    assert sorted(r.entity_id for r in quality.entities(readings).collect()) == ["a", "b"]
    profile = quality.entity_profile(readings).collect()
    assert [(r.entity_id, r.n_records, r.null_count, r.mean_value) for r in profile] == [("a", 2, 1, 2.0)]
    assert profile[0].std_value == pytest.approx(2**0.5)
    assert profile[0].time_span_hours == pytest.approx(2 / 60)
    assert quality.clean(readings).select("entity_id").distinct().count() == 1


def test_gap_of_exactly_n_is_no_gap(make):
    minutes = {"e": [0, 10, 20 + 1e-4]}
    arranged = quality.arrange_readings(make({"e": [1, 2, 3]}, minutes), 2)
    got = [r.segment_id for r in quality.segments(arranged, 10).orderBy("row_key").collect()]
    assert got == [0, 0, 1]
    report = quality.gap_report(arranged, 10).first()
    assert (report.n_gaps, round(report.max_gap_minutes, 3)) == (1, 10.0)
    assert quality.segment_counts(quality.segments(arranged, 10)).first().n_segments == 2


def test_reading_at_the_cut_is_test(make):
    minutes = {"e": [0, 1, 2, 2 + 7 * 24 * 60]}
    got = quality.time_split(make({"e": [1, 2, 3, 4]}, minutes), 7).orderBy("row_key").collect()
    assert [r.split for r in got] == ["train", "train", "test", "test"]
    assert quality.split_report(quality.time_split(make({"e": [1, 2, 3, 4]}, minutes), 7)).first().train_size == 2


def test_equal_times_follow_the_row_key(make):
    readings = make({"e": [5, 6, 7]}, {"e": [0, 0, 0]})
    got = quality.time_delta(quality.arrange_readings(readings, 3)).orderBy("row_key")
    assert [r.gap_minutes for r in got.collect()] == [None, 0.0, 0.0]
    assert starts(readings, size=3, names=["consecutive_increases"])["consecutive_increases"].tolist() == [2]
    assert got.agg(F.count("*")).first()[0] == 3
