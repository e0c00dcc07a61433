import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from sensorloom.operators import sketches

from conftest import START



def readings(spark, series, per_day=500):
    rows = [(k, START + dt.timedelta(days=i // per_day, seconds=i % per_day), None if v is None else float(v)) for k, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "entity_id string, time timestamp, value double").repartition(4)


def told(df, keys, levels):
    merged = sketches.merge_sketches(df, keys, ["n_values"])
    return {tuple(r[k] for k in keys): r for r in sketches.estimates(merged, keys, ["n_values"], levels).collect()}


def rank_error(xs, guess, p):
    low, high = np.mean(xs < guess), np.mean(xs <= guess)
    return max(0.0, low - p, p - high)


def test_errors_stay_in_their_bounds(spark):
    """Skewed, tied and heavy-tailed series, merged from days, over series, and from merges."""
    rng = np.random.default_rng(1)
    series = {"hot": rng.normal(size=6000), "ties": rng.integers(0, 40, 2000), "tail": rng.pareto(1, 2000)}
    levels = {"p1": 0.01, "p50": 0.5, "p99": 0.99}
    days = sketches.daily_sketches(readings(spark, series), ["entity_id"], {"n_values": F.col("value")})
    assert days.count() == 12 + 4 + 4
    got = told(days, ["entity_id"], levels)
    everything = np.concatenate(list(series.values()))
    got |= {("all",): told(days, [], levels)[()]}
    twice = sketches.merge_sketches(sketches.merge_sketches(days, ["entity_id"], ["n_values"]), [], ["n_values"])
    got |= {("again",): sketches.estimates(twice, [], ["n_values"], levels).first()}
    for name, xs in {**series, "all": everything, "again": everything}.items():
        r = got[name,]
        assert r.n == len(xs)
        assert abs(r.n_values - len(np.unique(xs))) <= 4 * sketches.DISTINCT_ERROR * len(np.unique(xs)) + 1
        assert max(rank_error(xs, r[c], p) for c, p in levels.items()) <= 2 * sketches.RANK_ERROR


def test_periods_from_the_store(spark, tmp_path):
    df = readings(spark, {"a": np.arange(2000.0), "b": np.zeros(1000)})
    of = {"n_values": F.col("value")}
    path = str(tmp_path / "days")
    sketches.write_sketches(sketches.daily_sketches(df, ["entity_id"], of), path)
    first = START.date() + dt.timedelta(days=1)
    part = sketches.read_sketches(spark, path, first, first + dt.timedelta(days=1))
    got = told(part, ["entity_id"], {"p50": 0.5})
    assert got["a",].n == 1000 and abs(got["a",].p50 - 1000) <= 20 and got["b",].n == 500 and got["b",].n_values == 1
    # A day written anew replaces that day alone.
    more = df.where(F.to_date("time") == F.lit(first)).withColumn("value", F.lit(7.0))
    sketches.write_sketches(sketches.daily_sketches(more, ["entity_id"], of), path)
    got = told(sketches.read_sketches(spark, path), ["entity_id"], {"p50": 0.5})
    assert got["a",].n == 2000 and got["b",].n == 1000 and got["b",].n_values == 2


def test_null_and_bad_values(spark):
    df = readings(spark, {"a": [None, None], "b": [None, 1.0, float("nan"), float("inf")]})
    got = told(sketches.daily_sketches(df, ["entity_id"], {"n_values": F.col("value")}), ["entity_id"], {"p50": 0.5})
    assert (got["a",].n, got["a",].n_values, got["a",].p50) == (0, 0, None)
    assert (got["b",].n, got["b",].n_values, got["b",].p50) == (1, 3, 1.0)


@pytest.mark.parametrize("n", [0])
def test_empty(spark, n):
    days = sketches.daily_sketches(readings(spark, {"a": [1.0]}).limit(n), ["entity_id"], {"n_values": F.col("value")})
    assert told(days, ["entity_id"], {"p50": 0.5}) == {}
