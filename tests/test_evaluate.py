import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import evaluate, forest, scaling, stats
from sensorloom.operators.quantile import exact_quantile

from conftest import START


def labelled(spark, scores, labels):
    rows = [(float(s), int(y), int(s < 0)) for s, y in zip(scores, labels)]
    return spark.createDataFrame(rows, "anomaly_score double, label int, flag int")


def area(scores, labels):
    low, high = [s for s, y in zip(scores, labels) if y], [s for s, y in zip(scores, labels) if not y]
    return sum((a < b) + (a == b) / 2 for a in low for b in high) / (len(low) * len(high))


def test_auc_small(spark):
    df = labelled(spark, [-0.1, -0.4, -0.35, -0.8], [0, 0, 1, 1])
    assert evaluate.roc_auc(df).first()[0] == pytest.approx(0.75)


def test_auc_with_ties_over_chunks(spark):
    rng = np.random.default_rng(6)
    scores, labels = np.round(rng.normal(0, 1, 300), 1), rng.integers(0, 2, 300)
    df = labelled(spark, scores, labels)
    assert evaluate.roc_auc(df, 5).first()[0] == pytest.approx(area(scores, labels))
    points = evaluate.roc_points(df, 5).orderBy("threshold").toPandas()
    for _, p in points.iterrows():
        assert p["tpr"] == pytest.approx((scores[labels == 1] <= p["threshold"] + 1e-12).mean())
        assert p["fpr"] == pytest.approx((scores[labels == 0] <= p["threshold"] + 1e-12).mean())


def test_one_class(spark):
    row = evaluate.evaluation(labelled(spark, [0.1, 0.2, 0.3], [0, 0, 0])).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (3, 0, 0, 0)
    assert (row.precision, row.recall, row.f1, row.roc_auc) == (0, 0, 0, None)


def test_confusion_and_rates(spark):
    row = evaluate.evaluation(labelled(spark, [-1, -1, 1, 1, -1], [1, 0, 1, 0, 1])).first()
    assert (row.tn, row.fp, row.fn, row.tp) == (1, 1, 1, 2)
    assert (row.precision, row.recall, row.f1) == pytest.approx((2 / 3, 2 / 3, 2 / 3))


def test_severity(spark):
    scored = spark.createDataFrame([(-0.2,), (0.0,), (0.3,)], "anomaly_score double")
    got = evaluate.severity(evaluate.flag_anomalies(scored)).orderBy("anomaly_score").collect()
    assert [r.severity_score for r in got] == [0, 40, 100]
    assert [r.severity_high_is_bad for r in got] == [100, 60, 0]
    assert [r.is_anomaly for r in got] == [True, False, False]
    flat = evaluate.severity(spark.createDataFrame([(0.1,), (0.1,)], "anomaly_score double")).collect()
    assert [r.severity_score for r in flat] == [50, 50]
    assert evaluate.severity(scored.where("false")).count() == 0


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0, float(x)) for x in [0, 1, 4.9, 5, 10, 10]] + [(1, 3.0)], "c int, x double")
    got = {(r.c, r.bin): r.n for r in evaluate.histogram(df, "x", "c", 2).collect()}
    assert got == {(0, 0): 3, (0, 1): 3, (1, 0): 1}


@pytest.mark.parametrize(
    "values",
    [
        np.random.default_rng(7).normal(0, 1, 501),
        np.r_[np.zeros(300), np.ones(5), [1e9]],
        np.random.default_rng(8).lognormal(0, 20, 400),
        np.nextafter(1.0, 2.0) * np.r_[np.ones(3)],
        np.r_[1.0, np.nextafter(1.0, 2.0), 1.0, np.nextafter(1.0, 2.0)],
        np.array([3.0]),
    ],
)
def test_exact_quantile(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    for p in (0.0, 0.07, 0.5, 0.93, 1.0):
        assert exact_quantile(df, "x", p) == pytest.approx(np.quantile(values, p), rel=1e-12), p
    assert exact_quantile(df.where("false"), "x", 0.5) is None


def test_scaler_and_cleaning(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0), (float("inf"), 5.0)], "a double, b double")
    fitted = scaling.scaler_values(scaling.fit_scaler(df, ["a", "b"]))
    assert fitted["a"] == pytest.approx((1.0, np.std([1, 3, 0, 0])))
    assert fitted["b"] == (5.0, 0.0)
    scaled = scaling.scale(df, ["a", "b"], fitted).toPandas()
    assert scaled["a"].mean() == pytest.approx(0) and (scaled["b"] == 0).all()
    with pytest.raises(ValueError):
        scaling.scale(df, ["c"], {"c": (0, 1)})


def test_correlation_with_gaps(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(100, 1, (200, 3))
    x[:, 1] = x[:, 0] * 2 + rng.normal(0, 0.1, 200)
    x[::7, 2] = np.nan
    rows = [(*[None if np.isnan(v) else float(v) for v in r], 1.0, "t") for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double, t string").repartition(3)
    got = {(r.feature_a, r.feature_b): r["corr"] for r in stats.feature_correlation(df).collect()}
    seen = ~np.isnan(x[:, 2])
    assert len(got) == 16
    assert got[("a", "b")] == got[("b", "a")] == pytest.approx(np.corrcoef(x[:, 0], x[:, 1])[0, 1])
    assert got[("a", "c")] == pytest.approx(np.corrcoef(x[seen, 0], x[seen, 2])[0, 1])
    assert got[("a", "k")] is None and got[("k", "k")] is None


def test_statistics_and_top(spark):
    df = spark.createDataFrame([(1.0, 1, "x"), (3.0, 1, "y")], "a double, b int, t string")
    table = stats.feature_statistics(df)
    assert {(r.feature, r["mean"], r["std"], r.n_windows) for r in table.collect()} == {("a", 2.0, 2**0.5, 2), ("b", 1.0, 0.0, 2)}
    assert [r.feature for r in stats.top_features(table, 1).collect()] == ["a"]


# ---------------------------------------------------------------- forest


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(0, 1, (3000, 4))
    x[:60] += 6
    rows = [(f"e{i % 7}", START + dt.timedelta(minutes=i), int(i < 60), *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "entity_id string, window_start timestamp, label int, a double, b double, c double, d double")


IDS, NAMES = ["entity_id", "window_start"], ["a", "b", "c", "d"]


def test_forest_finds_planted_outliers(planted):
    model, train = forest.fit_forest(planted, NAMES, IDS, contamination=0.02)
    got = evaluate.flag_anomalies(train)
    assert got.agg(F.avg("anomaly_prediction")).first()[0] == pytest.approx(0.02, abs=0.001)
    scored = got.withColumn("flag", F.col("anomaly_prediction"))
    assert evaluate.roc_auc(scored).first()[0] > 0.99
    again = forest.score_rows(planted, model)
    assert again.agg(F.min("anomaly_score")).first()[0] == pytest.approx(train.agg(F.min("anomaly_score")).first()[0])


def test_forest_ignores_affine_scaling(planted):
    moved = planted.withColumns({c: F.col(c) * 4 + 16 for c in NAMES})
    _, one = forest.fit_forest(planted, NAMES, IDS, trees=20)
    _, two = forest.fit_forest(moved, NAMES, IDS, trees=20)
    both = one.join(two.withColumnRenamed("anomaly_score", "other"), IDS)
    assert both.agg(F.max(F.abs(F.col("anomaly_score") - F.col("other")))).first()[0] < 1e-6


@pytest.mark.parametrize("trees", [2, 50])
def test_samples_are_full_and_distinct(planted, trees):
    """With few trees every row falls into one slice at most; with many, slices overlap."""
    drawn = forest.sample_rows(planted, IDS, 3000, trees, 64, 1)
    counts = drawn.groupBy("tree").agg(F.count("*").alias("n"), F.count_distinct(*IDS).alias("d")).collect()
    assert len(counts) == trees and all(r.n == r.d == 64 for r in counts)


def test_trees_partition_their_sample(planted):
    drawn = forest.sample_rows(planted, IDS, 3000, 5, 64, 1)
    nodes = forest.grow_forest(drawn, NAMES, 64, 1).toPandas()
    leaves = nodes[nodes["feature"] < 0]
    assert (leaves.groupby("tree")["size"].sum() == 64).all()
    assert nodes["depth"].max() <= 6
    size = nodes.set_index(["tree", "node"])["size"]
    for r in nodes[nodes["feature"] >= 0].itertuples():
        assert size[(r.tree, r.left)] + size[(r.tree, r.right)] == r.size


def test_average_path():
    assert forest.average_path(np.array([1, 2])).tolist() == [0, 1]
    assert float(forest.average_path(256)) == pytest.approx(10.2448, abs=1e-3)


@pytest.mark.parametrize("n_rows, trees", [(3000, 2), (3000, 11), (3000, 12), (3000, 50), (300, 7), (100_000, 5)])
def test_one_formula_draws_at_every_size(spark, n_rows, trees):
    """The trees of a row are those whose slice of the ring holds it, few or many."""
    import hashlib

    size, seed = 64, 1
    rows = [("e", k) for k in range(min(n_rows, 3000))]
    drawn = forest.sample_rows(spark.createDataFrame(rows, "entity_id string, k bigint"), ["entity_id", "k"], n_rows, trees, 10**6, seed)
    share = min(1.0, 4 * 10**6 / n_rows)
    drawn_small = forest.sample_rows(spark.createDataFrame(rows, "entity_id string, k bigint"), ["entity_id", "k"], n_rows, trees, size, seed)
    share_small = min(1.0, 4 * size / n_rows)
    for table, s, limit in ((drawn, share, None), (drawn_small, share_small, size)):
        want = {}
        for e, k in rows:
            u = int(hashlib.md5(f"{seed}|{e}|{k}".encode()).hexdigest()[:13], 16) / (1 << 52)
            for t in range(trees):
                x = u - t * s
                if x - np.floor(x) < s:
                    want.setdefault(t, set()).add(k)
        got = {}
        for r in table.collect():
            got.setdefault(r.tree, set()).add(r.k)
        if limit is None:
            assert got == want
        else:
            assert all(got.get(t, set()) <= w and len(got.get(t, set())) == min(limit, len(w)) for t, w in want.items())


def test_rows_with_equal_ids_are_drawn_alike(spark):
    rows = [("e", i // 2, float(i)) for i in range(200)]
    one = spark.createDataFrame(rows, "entity_id string, k int, x double")
    two = spark.createDataFrame(rows[::-1], "entity_id string, k int, x double").repartition(3)
    pick = lambda df: sorted((r.tree, r.x) for r in forest.sample_rows(df, ["entity_id", "k"], 200, 3, 33, 1).collect())
    assert pick(one) == pick(two)


def test_quantiles_of_odd_columns(spark):
    from sensorloom.operators.quantile import exact_quantile

    frame = lambda values: spark.createDataFrame([(v,) for v in values], "x double")
    nan, inf = float("nan"), float("inf")
    assert exact_quantile(frame([1.0, 2.0, 3.0, 4.0, nan]), "x", 0.5) == 2.5
    assert exact_quantile(frame([nan, nan]), "x", 0.5) is None
    assert exact_quantile(frame([-1.7e308, 0.5, 1.7e308]), "x", 0.5) == 0.5
    assert exact_quantile(frame([-inf, -1e308, 1.0, 2.0, 1e308, inf, inf]), "x", 0.5) == 2.0
    assert exact_quantile(frame([-inf, -inf, 3.0]), "x", 0.0) == -inf


def test_spread_is_relative_to_the_mean(spark):
    from sensorloom.operators import scaling

    rows = [(1e-14 * i, 5.0) for i in range(10)]
    table = spark.createDataFrame(rows, "tiny double, flat double")
    fitted = scaling.scaler_values(scaling.fit_scaler(table, ["tiny", "flat"]))
    got = scaling.scale(table, ["tiny", "flat"], fitted).agg(F.stddev_pop("tiny"), F.max(F.abs("flat"))).first()
    assert got[0] == pytest.approx(1.0) and got[1] == 0.0
