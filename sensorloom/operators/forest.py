"""Isolation forest: sampled and grown per tree, scored on all rows.

Only the samples (trees x 256 rows by default) leave the feature table. Trees are independent groups of
that bounded size; the finished forest is a table of at most trees x 511 nodes (``MAX_NODES`` for the
largest settings), which every scoring task gets whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.config import MAX_TREE_SAMPLE, MAX_TREES
from sensorloom.functions.columns import uniform52
from sensorloom.operators.quantile import exact_quantile
from sensorloom.operators.scaling import fit_scaler, scale, scaler_values
from sensorloom.session import freeze

EULER_GAMMA = 0.5772156649
OVERSAMPLE = 4
MAX_NODES = MAX_TREES * (2 * MAX_TREE_SAMPLE - 1)
NODES = "tree int, node int, feature int, threshold double, left int, right int, depth int, size bigint"


@dataclass
class ForestModel:
    """Everything needed to score: tables as DataFrames, numbers as values."""

    names: list[str]
    scaler: DataFrame
    nodes: DataFrame
    sample_size: int
    offset: float

    def meta(self) -> dict[str, str]:
        return {
            "names": ",".join(self.names),
            "sample_size": str(self.sample_size),
            "offset": repr(self.offset),
        }


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype=float)
    big = np.where(n > 2, n, 3.0)
    path = 2 * (np.log(big - 1) + EULER_GAMMA) - 2 * (big - 1) / big
    return np.where(n > 2, path, np.where(n == 2, 1.0, 0.0))


def _row_text(rows: DataFrame, ids: Sequence[str]):
    kinds = dict(rows.dtypes)
    parts = [F.unix_micros(c) if kinds[c] == "timestamp" else F.col(c) for c in ids]
    return F.concat_ws("|", *[p.cast("string") for p in parts])


def sample_rows(rows: DataFrame, ids: Sequence[str], n_rows: int, trees: int, size: int, seed: int) -> DataFrame:
    """``size`` random rows for each tree, without replacement: the input plus a ``tree`` column.

    One hash per row places it on a ring; tree t draws from the t-th slice of the ring, which
    is expected to hold four times the sample, and keeps the rows first in a second hash. On
    large tables a row falls into one slice at most, so nothing is multiplied.
    """
    share = min(1.0, OVERSAMPLE * size / n_rows)
    placed = rows.select(_row_text(rows, ids).alias("_id"))
    placed = placed.withColumn("_u", uniform52(F.concat(F.lit(f"{seed}|"), "_id")))
    # Slice t is [t * share, t * share + share) on a ring of length 1. The trees near the place of a
    # row on each turn of the ring are tried, so the work follows the copies made, not the trees.
    turns = int((trees - 1) * share) + 1
    near = (
        f"flatten(transform(sequence(0, {turns}), k -> transform(sequence(-1, 1), j -> "
        f"cast(floor((_u + k) / {share!r}d) as int) + j)))"
    )
    inside = (
        f"array_distinct(filter({near}, t -> t >= 0 and t < {trees} and "
        f"_u - t * {share!r}d - floor(_u - t * {share!r}d) < {share!r}d))"
    )
    # The ids alone are drawn and ordered; whole rows only meet the ``trees * size`` ids that are chosen.
    drawn = placed.select("_id", F.explode(F.expr(inside)).alias("tree"))
    drawn = drawn.withColumn("_order", uniform52(F.concat_ws("|", F.lit(seed), "tree", "_id")))
    place = F.row_number().over(Window.partitionBy("tree").orderBy("_order", "_id"))
    chosen = drawn.withColumn("_rank", place).where(F.col("_rank") <= size).drop("_rank").distinct()
    met = rows.withColumn("_id", _row_text(rows, ids)).join(freeze(chosen, "chosen"), "_id")
    # Rows with equal ids are told apart by the rest of their columns, whatever order they come in.
    first = Window.partitionBy("tree").orderBy("_order", "_id", *[c for c in rows.columns if c not in ids])
    return met.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= size).drop("_rank", "_id", "_order")


def _steady(x: np.ndarray) -> np.ndarray:
    """Features on 9 decimals, so that no tree splits on rounding noise."""
    return np.round(x, 9)


def _draw(seed: int, tree: int, node: int, what: str) -> float:
    digest = hashlib.md5(f"{seed}|{tree}|{node}|{what}".encode()).hexdigest()
    return int(digest[:13], 16) / (1 << 52)


def _grow(names: Sequence[str], max_depth: int, seed: int):
    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        """Nodes are numbered as in a heap: the children of k are 2k and 2k + 1."""
        tree = int(sample["tree"].iloc[0])
        x = _steady(sample[list(names)].to_numpy(float))
        nodes, todo = [], [(1, np.arange(len(x)), 0)]
        while todo:
            node, rows, depth = todo.pop()
            part = x[rows]
            low, high = part.min(0), part.max(0)
            usable = np.flatnonzero(high > low)
            if depth == max_depth or not len(usable):
                nodes.append((tree, node, -1, 0.0, -1, -1, depth, len(rows)))
                continue
            feature = int(usable[int(_draw(seed, tree, node, "feature") * len(usable))])
            cut = low[feature] + _draw(seed, tree, node, "cut") * (high[feature] - low[feature])
            # A cut that rounds up to the highest value would leave the right side empty.
            cut = min(cut, np.nextafter(high[feature], low[feature]))
            goes_left = part[:, feature] <= cut
            nodes.append((tree, node, feature, cut, 2 * node, 2 * node + 1, depth, len(rows)))
            todo += [(2 * node, rows[goes_left], depth + 1), (2 * node + 1, rows[~goes_left], depth + 1)]
        return pd.DataFrame(nodes, columns=[c.split()[0] for c in NODES.split(", ")])

    return grow


def grow_forest(sample: DataFrame, names: Sequence[str], size: int, seed: int) -> DataFrame:
    depth = max(1, math.ceil(math.log2(size)))
    rows = sample.select("tree", *names)
    return rows.groupBy("tree").applyInPandas(_grow(names, depth, seed), NODES)


def _flat(nodes: pd.DataFrame):
    """All trees in one set of arrays, siblings side by side.

    A row moves from node k to ``child[k]``, or to the node after it if its value is above the
    threshold. Leaves lead to themselves and carry their path length.
    """
    nodes = nodes.sort_values(["tree", "node"]).reset_index(drop=True)
    at = pd.Series(nodes.index, index=pd.MultiIndex.from_frame(nodes[["tree", "node"]]))
    leaf = (nodes["feature"] < 0).to_numpy()
    here = np.arange(len(nodes))
    left = at.reindex(pd.MultiIndex.from_frame(nodes[["tree", "left"]])).to_numpy()
    child = np.where(leaf, here, np.nan_to_num(left)).astype(np.int32)
    threshold = np.where(leaf, np.inf, nodes["threshold"])
    feature = np.where(leaf, 0, nodes["feature"]).astype(np.int32)
    path = nodes["depth"].to_numpy() + average_path(nodes["size"].to_numpy())
    return here[nodes["node"] == 1], feature, threshold, child, path, int(nodes["depth"].max())


def raw_scores(scaled: DataFrame, names: Sequence[str], nodes: DataFrame, sample_size: int, out: str) -> DataFrame:
    """-2^(-mean path / expected path): near -1 for rows that are isolated early.

    On 12 decimals, so that equal scores do not depend on the order of the trees.
    """
    held = nodes.limit(MAX_NODES + 1).toPandas()
    if len(held) > MAX_NODES:
        raise ValueError(f"a forest of more than {MAX_NODES} nodes is not sent to every task")
    flat = scaled.sparkSession.sparkContext.broadcast(_flat(held))
    expected = float(average_path(sample_size))

    @F.arrow_udf(T.DoubleType())
    def score(*columns: pa.Array) -> pa.Array:
        roots, feature, threshold, child, path, depth = flat.value
        x = _steady(np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns]))
        row, values, total = np.arange(len(x)) * x.shape[1], x.ravel(), np.zeros(len(x))
        for root in roots:
            node = np.full(len(x), root, np.int32)
            for _ in range(depth):
                value = values.take(row + feature.take(node))
                node = child.take(node) + (value > threshold.take(node))
            total += path.take(node)
        return pa.array(np.round(-(2.0 ** (-total / len(roots) / expected)), 12))

    return scaled.withColumn(out, score(*[F.col(n) for n in names]))


def fit_forest(
    features: DataFrame,
    names: Sequence[str],
    ids: Sequence[str],
    contamination: float = 0.07,
    trees: int = 100,
    sample: int = 256,
    seed: int = 42,
) -> tuple[ForestModel, DataFrame]:
    """Train on ``features``; also returns the training rows with ``anomaly_score``.

    The offset is the exact ``contamination`` quantile of the training scores, so that this
    share of the training rows scores below 0. The feature table should be a stored one: it is
    read for the scaler, for the samples and for the scores.
    """
    scaler = freeze(fit_scaler(features, names), "scaler")
    scaled = scale(features, names, scaler_values(scaler))
    n_rows = features.count()
    if not n_rows:
        raise ValueError("no training rows")
    size = min(sample, n_rows)
    drawn = sample_rows(features.select(*ids, *names), ids, n_rows, trees, size, seed)
    nodes = freeze(grow_forest(scale(drawn, names, scaler_values(scaler)), names, size, seed), "forest")
    raw = freeze(raw_scores(scaled, names, nodes, size, "_raw").drop(*names), "scores")
    offset = exact_quantile(raw, "_raw", contamination)
    model = ForestModel(list(names), scaler, nodes, size, offset)
    return model, raw.withColumn("anomaly_score", F.col("_raw") - F.lit(offset)).drop("_raw")


def score_rows(features: DataFrame, model: ForestModel, refit: bool = False) -> DataFrame:
    """Decision score per row (below 0 = anomaly); feature columns are dropped.

    ``refit`` scales by the scored rows themselves instead of the training rows.
    """
    scaler = fit_scaler(features, model.names) if refit else model.scaler
    scaled = scale(features, model.names, scaler_values(scaler))
    scored = raw_scores(scaled, model.names, model.nodes, model.sample_size, "_raw")
    return scored.withColumn("anomaly_score", F.col("_raw") - F.lit(model.offset)).drop("_raw", *model.names)
