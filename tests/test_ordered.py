"""Ordered operators over many chunks against plain pandas."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import ordered as o


@pytest.fixture(scope="module")
def frame(spark):
    """One series holds most rows, one has a single row, many rows share a time."""
    rng = np.random.default_rng(1)
    sizes = {"hot": 3000, "cold": 40, "one": 1, "warm": 500}
    rows, key = [], 0
    for name, n in sizes.items():
        for t in rng.integers(0, max(2, n // 3), n):
            v = float(rng.integers(0, 9))
            rows.append((key, name, int(t), v if rng.random() > 0.4 else None))
            key += 1
    return spark.createDataFrame(rows, "k bigint, s string, t bigint, v double")


@pytest.fixture(scope="module")
def arranged(frame):
    return o.arrange(frame, ["s"], ["t", "k"], partitions=7)


@pytest.fixture(scope="module")
def expected(frame):
    return frame.toPandas().sort_values(["s", "t", "k"]).reset_index(drop=True)


def by_key(df):
    return df.toPandas().sort_values("k").reset_index(drop=True)


def test_long_series_spans_chunks(arranged):
    chunks = arranged.where("s = 'hot'").select(o.CHUNK).distinct().count()
    assert chunks >= 4


def test_number(arranged, expected):
    got = by_key(o.number(arranged, ["s"], total="n"))
    expected = expected.assign(rn=expected.groupby("s").cumcount() + 1, n=expected.groupby("s")["k"].transform("size"))
    want = expected.sort_values("k")
    assert (got["rn"].to_numpy() == want["rn"].to_numpy()).all()
    assert (got["n"].to_numpy() == want["n"].to_numpy()).all()


def test_number_without_keys(arranged, expected):
    got = by_key(o.number(arranged, []))
    want = expected.assign(rn=np.arange(len(expected)) + 1).sort_values("k")
    assert (got["rn"].to_numpy() == want["rn"].to_numpy()).all()


def test_running_sum(arranged, expected):
    got = by_key(o.running_sum(arranged, ["s"], {"seen": F.col("v").isNotNull().cast("bigint"), "total": F.col("v")}))
    g = expected.groupby("s")["v"]
    want = expected.assign(
        seen=expected["v"].notna().groupby(expected["s"]).cumsum(), total=expected["v"].fillna(0).groupby(expected["s"]).cumsum()
    ).sort_values("k")
    assert g.ngroups == 4
    assert (got["seen"].to_numpy() == want["seen"].to_numpy()).all()
    assert np.allclose(got["total"], want["total"])


def test_previous(arranged, expected):
    got = by_key(o.previous(arranged, ["s"], {"pk": "k", "pv": "v"}))
    want = expected.assign(pk=expected.groupby("s")["k"].shift(), pv=expected.groupby("s")["v"].shift()).sort_values("k")
    assert np.array_equal(got["pk"], want["pk"], equal_nan=True)
    assert np.array_equal(got["pv"], want["pv"], equal_nan=True)


def test_fill_both_ways(arranged, expected):
    got = by_key(o.fill(arranged, ["s"], {"f": "v"}, {"b": "v"}))
    g = expected.groupby("s")["v"]
    want = expected.assign(f=g.ffill(), b=g.bfill()).sort_values("k")
    assert np.array_equal(got["f"], want["f"], equal_nan=True)
    assert np.array_equal(got["b"], want["b"], equal_nan=True)


def test_blocks_bound_groups_and_keep_neighbours(arranged):
    cut = o.blocks(o.number(arranged, ["s"]), ["s"], before=5, after=9, rows=64)
    sizes = cut.groupBy("s", o.BLOCK).count().toPandas()
    assert sizes["count"].max() <= 64 + 5 + 9
    assert o.own(cut).count() == arranged.count()
    framed = F.sum("rn").over(o.block_window(["s"]).rowsBetween(-5, 9))
    got = o.own(cut.withColumn("around", framed)).toPandas()
    for name, rows in got.groupby("s"):
        n = len(rows)
        for rn, around in zip(rows["rn"], rows["around"]):
            assert around == sum(range(max(1, rn - 5), min(n, rn + 9) + 1)), name


def test_hash_rank(frame):
    ranked = o.hash_rank(frame.withColumn("u", F.expr("pmod(hash(k), 1000L) * 4000000")), ["s"], "u", "k").toPandas()
    ranked = ranked.sort_values(["s", "u", "k"])
    assert (ranked["hash_rank"] == ranked.groupby("s").cumcount() + 1).all()
