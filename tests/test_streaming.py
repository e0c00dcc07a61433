import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from sensorloom.operators import quality, windows
from sensorloom.streaming import live, sessions
from sensorloom.streaming import windows as stream_windows

from conftest import START

NAMES = ["n_points", "mean_oxygen", "median", "max_zscore", "consecutive_increases"]


def readings_of(lengths, seed=0, gaps=None):
    """Random rows of several series: (row_key, time, entity_id, value), a sixth of the values null-free."""
    rng, rows, key = np.random.default_rng(seed), [], 0
    for name, n in lengths.items():
        minutes = np.cumsum(rng.exponential(3, n) if gaps is None else rng.choice(gaps, n))
        for m in minutes:
            rows.append((key, START + dt.timedelta(minutes=round(float(m), 3)), name, round(float(rng.normal(50, 5)), 3)))
            key += 1
    return rows


def put(spark, folder, rows):
    spark.createDataFrame(rows, live.READINGS).coalesce(1).write.mode("append").parquet(folder)


def in_parts(rows, n):
    rows = sorted(rows, key=lambda r: r[1])
    return [rows[len(rows) * i // n : len(rows) * (i + 1) // n][::-1] for i in range(n)]


def batch(spark, rows, size=12, step=1):
    arranged = quality.arrange_readings(spark.createDataFrame(rows, live.READINGS))
    return windows.extract_features(arranged, ["entity_id"], size, step, NAMES)


def told(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_stream_equals_batch_and_goes_on_after_a_restart(spark, tmp_path):
    rows = readings_of({"a": 300, "b": 40, "c": 11, "d": 12})
    rows = [(*r[:3], None if r[0] % 37 == 5 else r[3]) for r in rows]
    parts, (folder, out, at) = in_parts(rows, 5), (str(tmp_path / x) for x in ("in", "out", "at"))
    for part in parts[:3]:
        put(spark, folder, part)
    found = stream_windows.stream_features(live.open_readings(spark, folder, 1), 12, 1, NAMES, "10 minutes", chunk_rows=16)
    assert live.run_available(found, out, at) == 0
    before = live.results(spark, out, found).count()
    for part in parts[3:]:
        put(spark, folder, part)
    live.end_stream(spark, folder, max(r[1] for r in rows) + dt.timedelta(hours=1))
    again = stream_windows.stream_features(live.open_readings(spark, folder, 1), 12, 1, NAMES, "10 minutes", chunk_rows=16)
    assert live.run_available(again, out, at) == 0
    want = told(batch(spark, rows))
    assert 0 < before < len(want) and told(live.results(spark, out, again)) == want


def test_a_run_that_dies_is_taken_up(spark, tmp_path):
    """The first run fails in its third batch: what it stored before is neither lost nor doubled."""
    rows = readings_of({"a": 200, "b": 60}, seed=3)
    folder, out, at = (str(tmp_path / x) for x in ("in", "out", "at"))
    for part in in_parts(rows, 4):
        put(spark, folder, part)
    live.end_stream(spark, folder, max(r[1] for r in rows) + dt.timedelta(hours=1))
    found = stream_windows.stream_features(live.open_readings(spark, folder, 1), 12, 1, NAMES, "10 minutes")
    limit = sorted(r[1] for r in rows)[130]
    broken = found.withColumn("n_points", F.when(F.col("window_end") < F.lit(limit), F.col("n_points")).otherwise(F.raise_error(F.lit("broken")).cast("bigint")))
    with pytest.raises(Exception, match="broken"):
        live.run_available(broken, out, at)
    assert live.run_available(stream_windows.stream_features(live.open_readings(spark, folder, 1), 12, 1, NAMES, "10 minutes"), out, at) == 0
    assert told(live.results(spark, out, found)) == told(batch(spark, rows))


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    rows = readings_of({"a": 120}, seed=1)
    first, last = in_parts(rows, 2)
    late = [r for r in first if r[0] in (10, 20)]
    folder, out, at = (str(tmp_path / x) for x in ("in", "out", "at"))
    put(spark, folder, [r for r in first if r not in late])
    put(spark, folder, last)
    put(spark, folder, late)  # hours behind by now
    live.end_stream(spark, folder, max(r[1] for r in rows) + dt.timedelta(hours=1))
    found = stream_windows.stream_features(live.open_readings(spark, folder, 1), 12, 5, NAMES, "10 minutes")
    assert live.run_available(found, out, at) == 2
    assert told(live.results(spark, out, found)) == told(batch(spark, [r for r in rows if r not in late], step=5))


def segments(spark, rows, gap):
    return quality.segment_stats(quality.segments(quality.arrange_readings(spark.createDataFrame(rows, live.READINGS)), gap))


def test_segments_equal_batch(spark, tmp_path):
    # A gap of exactly the limit does not end a segment; one a bit longer does.
    rows = readings_of({"a": 200, "b": 50, "c": 1}, seed=2, gaps=[1, 5, 10, 10.001, 25])
    folder, out, at = (str(tmp_path / x) for x in ("in", "out", "at"))
    parts = in_parts(rows, 4)
    for part in parts[:2]:
        put(spark, folder, part)
    found = sessions.stream_segments(live.open_readings(spark, folder, 1), 10, "20 minutes")
    live.run_available(found, out, at)
    open_ones = told(segments(spark, rows, 10).select("entity_id", "start_time"))
    closed = told(live.results(spark, out, found).select("entity_id", "start_time"))
    assert closed and set(closed) < set(open_ones)
    for part in parts[2:]:
        put(spark, folder, part)
    put(spark, folder, [(9999, min(r[1] for r in rows), "a", 1.0)])  # too late
    live.end_stream(spark, folder, max(r[1] for r in rows) + dt.timedelta(hours=2))
    found = sessions.stream_segments(live.open_readings(spark, folder, 1), 10, "20 minutes")
    assert live.run_available(found, out, at) == 1
    rounded = lambda df: df.withColumn("mean_value", F.round("mean_value", 6))
    got = rounded(sessions.numbered(live.results(spark, out, found)))
    assert told(got) == told(rounded(segments(spark, rows, 10)))
