import datetime as dt
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import inject, labels, quality, windows
from sensorloom.session import freeze

from conftest import START


def uniform(key, salt):
    return int(hashlib.md5(f"{key}|{salt}".encode()).hexdigest()[:8], 16) / 4294967296


def rows_of(spark, events, n=100):
    """Test rows with the given events: {rn: (event_no, type)}."""
    rows = []
    for i in range(1, n + 1):
        no, kind = events.get(i, (None, None))
        rows.append((i + 1000, START + dt.timedelta(minutes=i), "e", "test", 10.0 + i, i, no, kind))
    schema = "row_key bigint, time timestamp, entity_id string, split string, value double, rn bigint, event_no bigint, type string"
    return spark.createDataFrame(rows, schema)


def brute(events, n=100):
    """Apply the faults one after another in order of their number."""
    value = {i: 10.0 + i for i in range(1, n + 1)}
    label = dict.fromkeys(value, 0)
    for start, (_, kind) in sorted(events.items(), key=lambda e: e[1][0]):
        length, shift, half = inject.FAULTS[kind]
        for i in range(start, min(start + length, n + 1)):
            key = i + 1000 if kind == "high_noise" else start + 1000
            value[i] = 10.0 + start + shift + (uniform(key, kind) * 2 * half - half if half else 0)
            label[i] = 1
    return value, label


@pytest.mark.parametrize(
    "events",
    [
        {91: (1, "collective_high")},
        {10: (2, "collective_low"), 30: (1, "stuck_sensor"), 35: (3, "point_spike")},
        {10: (1, "collective_low"), 30: (2, "stuck_sensor"), 35: (3, "high_noise"), 36: (4, "point_dip")},
        {1: (1, "high_noise"), 100: (2, "stuck_sensor")},
    ],
)
def test_faults(spark, events):
    got = {r.rn: r for r in inject.inject_events(rows_of(spark, events)).collect()}
    value, label = brute(events)
    assert len(got) == 100
    for i in range(1, 101):
        assert got[i].value == pytest.approx(value[i]), i
        assert got[i].anomaly_label == label[i]
        assert got[i].original_value == 10.0 + i


def test_log_gives_the_own_value(spark):
    log = inject.injection_log(rows_of(spark, {5: (1, "point_dip"), 9: (2, "stuck_sensor")})).collect()
    assert {r.type: round(r.injected_value - r.original_value, 9) for r in log} == {
        "point_dip": -5.0,
        "stuck_sensor": round(uniform(1009, "stuck_sensor") * 2 - 1, 9),
    }


def test_picks_are_exact_and_repeatable(make):
    split = quality.time_split(quality.arrange_readings(make({"b": range(400), "c": range(90)}), 3), 7)
    picked = inject.pick_events(split, "b", 0.1).where("event_no is not null")
    first = {r.event_no: r.rn for r in picked.collect()}
    assert sorted(first) == list(range(1, 41))
    assert first == {r.event_no: r.rn for r in picked.collect()}
    assert inject.default_entity(split) == "b"
    one = inject.pick_events(split, "b", 0.0001).where("event_no is not null")
    assert one.count() == 1


def test_covered_events_are_dropped(spark):
    events = {10: (1, "collective_low"), 30: (2, "stuck_sensor"), 50: (4, "point_spike"), 80: (3, "point_dip")}
    kept = inject.without_covered_events(rows_of(spark, events)).where("event_no is not null")
    assert sorted(r.rn for r in kept.collect()) == [10, 80]
    late = {10: (2, "collective_low"), 30: (1, "point_dip")}
    kept = inject.without_covered_events(rows_of(spark, late)).where("event_no is not null")
    assert sorted(r.rn for r in kept.collect()) == [10, 30]


def test_center_label_takes_the_first_of_equal_times(spark):
    rows = rows_of(spark, {}).withColumn("time", F.when(F.col("rn").isin(31, 32), F.lit(START)).otherwise(F.col("time")))
    rows = rows.withColumn("anomaly_label", F.col("rn").isin(31).cast("int"))
    w = spark.createDataFrame([("e", "test", START)], "entity_id string, split string, window_center timestamp")
    assert labels.center_label(w, rows, ["entity_id", "split"]).first().anomaly_label == 1


def test_nearest_label(spark):
    at = lambda s: START + dt.timedelta(seconds=s)
    seen = [("a", at(0), 1, 0), ("a", at(10), 2, 1), ("a", at(10), 3, 5), ("a", at(30), 4, 2), ("b", at(7), 5, 9)]
    readings = spark.createDataFrame(seen, "s string, time timestamp, row_key bigint, label int")
    asked = [("a", at(-5)), ("a", at(5)), ("a", at(6)), ("a", at(10)), ("a", at(10)), ("a", at(20)), ("a", at(99)), ("b", at(0)), ("c", at(0))]
    points = spark.createDataFrame(asked, "s string, at timestamp")
    got = labels.nearest_label(points, readings, ["s"], "at", "label", partitions=3).collect()
    want = {("a", -5): 0, ("a", 5): 0, ("a", 6): 1, ("a", 10): 1, ("a", 20): 1, ("a", 99): 2, ("b", 0): 9, ("c", 0): None}
    assert len(got) == len(asked)
    for r in got:
        assert r.label == want[(r.s, int((r.at - START).total_seconds()))], r


def test_missing_labels_count_as_normal(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "l int")
    assert [r[0] for r in df.select(labels.binary_label(F.col("l"))).collect()] == [1, 0, 0]


def test_window_labels_follow_the_centre(spark):
    rows = freeze(inject.inject_events(rows_of(spark, {50: (1, "point_spike")})), "t")
    table = windows.extract_features(rows, ["entity_id", "split"], 60, 1, ["mean_oxygen"], rn="rn")
    labelled = labels.center_label(table, rows, ["entity_id", "split"])
    ones = [r.window_center for r in labelled.collect() if r.anomaly_label == 1]
    assert ones == [START + dt.timedelta(minutes=50)]


def greedy_by_hand(events):
    kept = {}
    for start, (no, kind) in sorted(events.items()):
        if not any(n < no and s < start < s + inject.FAULTS[k][0] for s, (n, k) in kept.items()):
            kept[start] = (no, kind)
    return sorted(kept)


def test_a_dropped_fault_drops_no_others(spark):
    # 10 covers 50, which covers 90: 50 goes, so 90 stays. 95 lies in 90, but is numbered lower.
    events = {10: (1, "collective_low"), 50: (2, "collective_high"), 90: (4, "stuck_sensor"), 95: (3, "point_dip")}
    for rows in (8, 64, 2048):
        kept = inject.without_overlaps(rows_of(spark, events), rows_per_block=rows).where("event_no is not null")
        assert sorted(r.rn for r in kept.collect()) == [10, 90, 95] == greedy_by_hand(events)
    covered = inject.without_covered_events(rows_of(spark, events)).where("event_no is not null")
    assert sorted(r.rn for r in covered.collect()) == [10]


def test_greedy_choice_by_brute_force(spark):
    """A chain over all blocks, and random faults."""
    rng = np.random.default_rng(4)
    kinds = list(inject.FAULTS)
    chain = {1 + 20 * i: (i + 1, "collective_low") for i in range(5)}
    wild = {int(s): (int(n) + 1, kinds[rng.integers(0, 6)]) for n, s in enumerate(rng.permutation(np.arange(1, 101))[:60])}
    for events in (chain, wild):
        rows = rows_of(spark, events)
        kept = inject.without_overlaps(rows, rows_per_block=1)
        assert kept.count() == rows.count()
        assert sorted(r.rn for r in kept.where("event_no is not null").collect()) == greedy_by_hand(events)
