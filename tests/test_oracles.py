"""Registered queries against the same queries in SQL, on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as entry  # noqa: E402

TABLES = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(f"{TABLES}/events.parquet"), reason="no test tables")
# The cheap ones; the slow rest (forest, jobs, whole feature tables) runs outside the unit tests.
QUICK = [
    "load_profile",
    "numeric_coercion",
    "null_filter",
    "ts_parse",
    "null_key_entities",
    "csv_roundtrip",
    "entity_profile",
    "segments",
    "split_report",
    "forward_fill",
    "impute_spline",
    "window_counts",
    "segment_windows",
    "all_features",
    "feature_corr",
    "inject_rows",
    "uncovered_events",
    "nearest_label",
    "window_labels",
    "anomaly_predictions",
    "roc_points",
    "score_histogram",
    "feature_cache",
    "step_hold_blend",
    "forecast_metrics_by_position",
    "forecast_moments",
    "forecast_metrics",
    "forecast_head",
    "clean_store",
    "impute_knn_time",
    "time_windows",
    "time_windows_burst",
    "peak_thresholds",
    "sketch_profile",
    "alert_episodes",
    "greedy_events",
    "widening_interval",
    "baseline_choice",
]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view events as select * from read_parquet('{TABLES}/events.parquet')")
    got = entry.queries()[name](spark, TABLES).toPandas()
    want = con.execute(entry.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    order = lambda df: sorted(map(repr, df[columns].astype(object).where(df[columns].notna(), None).values.tolist()))
    assert order(got) == order(want)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "max_zscore" in df.columns
