"""Imputation of null readings over whole series."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.config import IMPUTATION_METHODS
from sensorloom.operators.ordered import blocks, fill, number, running_sum
from sensorloom.session import freeze

SERIES = ["entity_id"]
HALO_KNOTS = 40  # the influence of a knot decays by 3.7 per step: 40 knots are below double precision
BLOCK_KNOTS = 4096
KNOT = (("t", pa.int64()), ("rn", pa.int64()), ("value", pa.float64()))


def forward_fill(arranged: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Last known value; leading nulls stay null."""
    filled = fill(arranged, keys or SERIES, {"_known": "value"})
    return filled.withColumn("value", F.col("_known")).drop("_known")


def neighbour_mean(readings: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Nearest-neighbour imputation of a single column.

    A row without a value has no distance to any other row when the value is the only
    feature, so the imputer falls back to the mean of the series.
    """
    keys = keys or SERIES
    means = freeze(readings.groupBy(*keys).agg(F.avg("value").alias("_mean")), "means")
    joined = readings.join(means, keys)
    return joined.withColumn("value", F.coalesce("value", "_mean")).drop("_mean")


def _tridiagonal(low: np.ndarray, diag: np.ndarray, up: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Solve a diagonally dominant tridiagonal system by cyclic reduction of all rows at once.

    Each round removes the neighbours at the current distance and doubles it.
    """
    far = 1
    while far < len(diag):
        before = lambda v, fill=0.0: np.r_[np.full(far, fill), v[:-far]]
        behind = lambda v, fill=0.0: np.r_[v[far:], np.full(far, fill)]
        left, right = -low / before(diag, 1.0), -up / behind(diag, 1.0)
        diag, rhs, low, up = (
            diag + left * before(up) + right * behind(low),
            rhs + left * before(rhs) + right * behind(rhs),
            left * before(low),
            right * behind(up),
        )
        far *= 2
    return rhs / diag


def _second_derivatives(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Second derivatives of the not-a-knot cubic spline at its knots (at least 4)."""
    h, n = np.diff(x), len(x)
    slope = np.diff(y) / h
    diag = np.zeros(n)
    upper, lower, rhs = np.zeros(n - 1), np.zeros(n - 1), np.zeros(n)
    diag[1:-1] = 2 * (h[:-1] + h[1:])
    upper[1:], lower[:-1] = h[1:], h[:-1]
    rhs[1:-1] = 6 * np.diff(slope)
    # Equal third derivatives around the second and the last but one knot, with the outer
    # unknown eliminated so that the system stays tridiagonal.
    diag[1] += h[0] + h[0] ** 2 / h[1]
    upper[1] -= h[0] ** 2 / h[1]
    diag[-2] += h[-1] + h[-1] ** 2 / h[-2]
    lower[-2] -= h[-1] ** 2 / h[-2]
    m = np.zeros(n)
    m[1:-1] = _tridiagonal(np.r_[0.0, lower[1 : n - 2]], diag[1:-1], np.r_[upper[1 : n - 2], 0.0], rhs[1:-1])
    m[0] = m[1] - h[0] / h[1] * (m[2] - m[1])
    m[-1] = m[-2] + h[-1] / h[-2] * (m[-2] - m[-3])
    return m


def _pieces(keys: list[str]):
    def solve(knots: pd.DataFrame) -> pd.DataFrame:
        """Cubic to the right of each own knot that a null follows; the last knot continues the last interval.

        The first knot also serves the nulls before it. Blocks without such a knot are not solved.
        """
        knots = knots.sort_values("knot")
        gap = np.r_[np.diff(knots["rn"].to_numpy()) > 1, False]
        number = knots["knot"].to_numpy()
        wanted = knots["_own"].to_numpy() & (gap | (number == 1) | (number == knots["_knots"].to_numpy()))
        if not wanted.any():
            return knots.assign(x=0.0, a=0.0, b=0.0, c=0.0, d=0.0).iloc[:0][[*keys, "rn", *"xabcd"]]
        x, y = knots["rn"].to_numpy(float), knots["value"].to_numpy(float)
        m, h = _second_derivatives(x, y), np.diff(x)
        b = np.diff(y) / h - h * (2 * m[:-1] + m[1:]) / 6
        cubic = np.column_stack([x, y, np.r_[b, 0.0], m / 2, np.r_[np.diff(m) / (6 * h), 0.0]])
        cubic[-1] = cubic[-2]
        out = pd.concat([knots[[*keys, "rn"]].reset_index(drop=True), pd.DataFrame(cubic, columns=list("xabcd"))], axis=1)
        return out[wanted]

    return solve


def spline(arranged: DataFrame, keys: list[str] | None = None, block_knots: int = BLOCK_KNOTS) -> DataFrame:
    """Cubic spline over the row index, extrapolated at both ends.

    Series with fewer than 4 known values are forward filled, with fewer than 2 left as they
    are. The spline is solved on blocks of knots with a halo, so a group is bounded; nulls
    take the cubic of the knot before them (or after them, at the start) by a fill, so a long
    run of nulls is never gathered on its knot.
    """
    keys = keys or SERIES
    rows = number(arranged, keys)
    known = F.col("value").isNotNull()
    rows = freeze(running_sum(rows, keys, {"knot": known.cast("bigint")}), "knotted")
    counts = freeze(rows.groupBy(*keys).agg(F.count("value").alias("_knots")), "knots")
    rows = rows.join(counts, keys)

    knots = rows.where(known & (F.col("_knots") >= 4)).select(*keys, "rn", "knot", "value", "_knots")
    cut = blocks(knots, keys, rn="knot", before=HALO_KNOTS, after=HALO_KNOTS, rows=block_knots)
    schema = ", ".join(f"{k} {t}" for k, t in cut.dtypes if k in keys)
    schema += ", rn bigint, x double, a double, b double, c double, d double"
    solved = cut.groupBy(*keys, "_block").applyInPandas(_pieces(keys), schema)
    pieces = solved.select(*keys, "rn", F.struct("x", "a", "b", "c", "d").alias("_piece"))

    rows = freeze(rows.join(pieces, [*keys, "rn"], "left"), "pieces")
    rows = fill(rows, keys, {"_left": "_piece", "_last": "value"}, {"_right": "_piece"})
    p = F.coalesce("_left", "_right")
    t = F.col("rn") - p["x"]
    cubic = p["a"] + t * (p["b"] + t * (p["c"] + t * p["d"]))
    guess = F.when(F.col("_knots") >= 4, cubic).when(F.col("_knots") >= 2, F.col("_last"))
    out = rows.withColumn("value", F.coalesce("value", guess))
    return out.drop("rn", "knot", "_knots", "_piece", "_left", "_last", "_right")


def _borders(keys: list[str], k: int):
    def run(knots: pa.Table) -> pa.Table:
        """The k last known readings up to each own knot and the k first ones from it, where a null lies beside it."""
        knots = knots.sort_by("knot").combine_chunks()
        rn, n = knots.column("rn").to_numpy(), knots.num_rows
        outside = knots.column("knot").to_numpy() == knots.column("_knots").to_numpy()
        beside = np.r_[rn[:1] > 1, np.diff(rn) > 1] | np.r_[np.diff(rn) > 1, False] | outside
        own = np.flatnonzero(knots.column("_own").to_numpy() & beside)
        entry = pa.StructArray.from_arrays([knots.column(c).chunk(0) if n else pa.array([], t) for c, t in KNOT], [c for c, _ in KNOT])

        def lists(first: np.ndarray, last: np.ndarray) -> pa.Array:
            ends = np.r_[0, np.cumsum(last - first)]
            at = np.arange(ends[-1]) + np.repeat(first - ends[:-1], last - first)
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entry.take(pa.array(at)))

        columns = [knots.column(c).take(pa.array(own)) for c in [*keys, "rn"]]
        before, after = lists(np.maximum(own + 1 - k, 0), own + 1), lists(own, np.minimum(own + k, n))
        return pa.table([*columns, before, after], [*keys, "rn", "_before", "_after"])

    return run


def nearest_in_time(arranged: DataFrame, k: int = 5, keys: list[str] | None = None, block_knots: int = BLOCK_KNOTS) -> DataFrame:
    """Mean of the ``k`` known readings nearest in time; of equally near ones those fewer rows away, then the earlier.

    With fewer known readings all count, and a series without one keeps its nulls. A null's nearest lie among the k known
    ones before and the k after it. Known readings are numbered and cut into blocks that overlap by k, so k may span
    any number of chunks; the lists are made only where a null follows or precedes, and reach the nulls of
    a run, however long, by a fill in both directions.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    keys = keys or SERIES
    known = F.col("value").isNotNull()
    rows = freeze(running_sum(number(arranged, keys), keys, {"knot": known.cast("bigint")}), "knotted")
    counts = freeze(rows.groupBy(*keys).agg(F.count("value").alias("_knots")), "knots")
    t = F.unix_micros("time")
    knots = rows.where(known).join(counts, keys).select(*keys, "rn", "knot", "_knots", t.alias("t"), "value")
    cut = blocks(knots, keys, rn="knot", before=k, after=k, rows=block_knots)
    entry = "array<struct<t: bigint, rn: bigint, value: double>>"
    schema = ", ".join([*(f"{c} {kind}" for c, kind in cut.dtypes if c in keys), "rn bigint", f"_before {entry}", f"_after {entry}"])
    borders = cut.groupBy(*keys, "_block").applyInArrow(_borders(keys, k), schema)
    met = freeze(rows.join(borders, [*keys, "rn"], "left"), "borders")
    near = fill(met, keys, {"_left": "_before"}, {"_right": "_after"})
    empty = F.from_json(F.lit("[]"), entry)
    both = F.concat(F.coalesce("_left", empty), F.coalesce("_right", empty))
    placed = F.transform(both, lambda x: F.struct(F.abs(x["t"] - t), F.abs(x["rn"] - F.col("rn")), x["rn"], x["value"].alias("value")))
    taken = F.slice(F.array_sort(placed), 1, k)
    mean = F.try_divide(F.aggregate(taken, F.lit(0.0), lambda a, x: a + x["value"]), F.size(taken).cast("double"))
    out = near.withColumn("value", F.coalesce("value", mean))
    return out.drop("rn", "knot", "_before", "_after", "_left", "_right")


def ensemble(readings: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Neighbour mean first, spline for what is still null.

    The mean fills every series that has a value at all and a series without one has no
    spline either, so the second stage finds nothing left to do on a single column.
    """
    return neighbour_mean(readings, keys)


def impute(arranged: DataFrame, method: str, keys: list[str] | None = None) -> DataFrame:
    """Fill null values of arranged readings by the named method."""
    if method not in IMPUTATION_METHODS:
        raise ValueError(f"unknown imputation method {method!r}")
    if method == "spline":
        return spline(arranged, keys)
    if method == "knn_time":
        return nearest_in_time(arranged, keys=keys)
    if method == "forward_fill":
        return forward_fill(arranged, keys)
    return neighbour_mean(arranged, keys) if method == "knn" else ensemble(arranged, keys)


def missing_counts(before: DataFrame, after: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Nulls per series before and after imputation."""
    keys = keys or SERIES
    nulls = F.count_if(F.col("value").isNull())
    left = before.groupBy(*keys).agg(nulls.alias("nulls_before"))
    right = after.groupBy(*keys).agg(nulls.alias("nulls_after"))
    return left.join(right, keys)

