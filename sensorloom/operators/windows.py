"""Sliding row windows per series and their feature table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.window_features import FEATURES, GROUPS, group_features
from sensorloom.operators.ordered import BLOCK, CHUNK, POS, block_window, blocks, number, own

META = (
    "window_start",
    "window_end",
    "window_center",
    "n_points",
    "mean_oxygen",
    "std_oxygen",
    "min_oxygen",
    "max_oxygen",
)
ROWS_PER_BLOCK = 2048
# Columns a model trains on: everything but the keys, the times and the label.
MODEL_FEATURES = (*META[3:], *FEATURES)


def series_keys(df: DataFrame, respect_segments: bool = False) -> list[str]:
    """Windows never cross a split; across gaps only if segments are not respected."""
    keys = ["entity_id"]
    if "split" in df.columns:
        keys.append("split")
    if respect_segments:
        keys.append("segment_id")
    return keys


def long_enough(readings: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Series with at least ``rows`` rows, with their length (report of the kept ones)."""
    return readings.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") >= rows)


def _per_block(
    arranged: DataFrame, keys: Sequence[str], size: int, step: int, rn: str | None, rows_per_block: int, schema: T.StructType, make: Callable
) -> DataFrame:
    """Cut series into blocks and give each block once to a task.

    ``make`` gets the block's rows in order, the places where its own windows begin (every
    ``step``-th row of the series), and their values as an n x ``size`` view with NaN for nulls.
    The cost follows the windows that are kept, and a reading travels once, not once a window.
    """
    numbered = arranged if rn else number(arranged, keys)
    rn = rn or "rn"
    cut = blocks(numbered, keys, rn, after=size - 1, rows=rows_per_block)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(rn).combine_chunks()
        values = np.array(rows.column("value").to_numpy(zero_copy_only=False), float)
        begins = rows.column("_own").to_numpy() & ((rows.column(rn).to_numpy() - 1) % step == 0)
        begins[max(0, len(values) - size + 1) :] = False
        at = np.flatnonzero(begins)
        view = np.lib.stride_tricks.sliding_window_view(values, size)[at] if len(at) else np.empty((0, size))
        return make(rows, at, view)

    return cut.groupBy(*keys, BLOCK).applyInArrow(run, schema)


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [df.schema[n] for n in names]


def sliding_windows(
    arranged: DataFrame,
    keys: Sequence[str],
    size: int = 60,
    step: int = 1,
    rn: str | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """One row per full window of ``size`` rows, every ``step`` rows of a series.

    Adds the window's first, last and middle time and its values in order (``values`` holds
    fewer than ``size`` entries if readings are null). The window's own columns are those of
    its first row.
    """
    names = [c for c in arranged.columns if c not in (POS, CHUNK)]
    names += [] if rn else ["rn"]
    time = arranged.schema["time"].dataType
    fields = [T.StructField("rn", T.LongType()) if c not in arranged.columns else arranged.schema[c] for c in names]
    added = [T.StructField("values", T.ArrayType(T.DoubleType())), T.StructField("window_end", time), T.StructField("window_center", time)]

    def make(rows: pa.Table, at: np.ndarray, view: np.ndarray) -> pa.Table:
        known = ~np.isnan(view)
        ends = np.concatenate([[0], np.cumsum(known.sum(1))])
        values = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(view[known]))
        times = rows.column("time")
        return pa.table([*(rows.column(c).take(at) for c in names), values, times.take(at + size - 1), times.take(at + size // 2)], [f.name for f in fields + added])

    found = _per_block(arranged, keys, size, step, rn, rows_per_block, T.StructType(fields + added), make)
    return found.withColumnRenamed("time", "window_start").withColumn("n_points", F.lit(size).cast("bigint"))


def window_counts(windows: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Windows in total, processed, and skipped because they still hold nulls."""
    whole = F.size("values") == size
    return windows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(whole).alias("n_processed"),
        F.count_if(~whole).alias("n_skipped"),
    )


def complete(windows: DataFrame, size: int) -> DataFrame:
    """Windows without nulls."""
    return windows.where(F.size("values") == size)


ALIAS = {"mean_oxygen": "mean", "std_oxygen": "std"}


def needed_groups(names: Sequence[str]) -> list[str]:
    """Groups of features that the named columns come from."""
    source = {f: g for g, fs in GROUPS.items() for f in fs}
    return sorted({source[ALIAS.get(n, n)] for n in names if ALIAS.get(n, n) in source})


def feature_arrays(view: np.ndarray, chosen: Sequence[str], needed: Sequence[str]) -> list[pa.Array]:
    """The chosen features of windows without nulls (one a row), from the groups they need."""
    found = {"min_oxygen": view.min(1), "max_oxygen": view.max(1)} if len(view) else {}
    for g in needed if len(view) else ():
        found |= group_features(g, view)
    columns = []
    for n in chosen:
        kind = pa.int64() if n == "n_points" else pa.float64()
        if not len(view):
            columns.append(pa.array([], kind))
            continue
        value = np.full(len(view), view.shape[1]) if n == "n_points" else found[ALIAS.get(n, n)].astype(float)
        columns.append(pa.array(value, kind, from_pandas=True))
    return columns


def extract_features(
    arranged: DataFrame,
    keys: Sequence[str],
    size: int = 60,
    step: int = 1,
    names: Sequence[str] | None = None,
    rn: str | None = None,
) -> DataFrame:
    """Features of the windows without nulls; keys and times first.

    Groups of features of which none is asked for are not evaluated.
    """
    chosen = [n for n in (names if names is not None else MODEL_FEATURES) if n not in (*keys, *META[:3])]
    needed = needed_groups(chosen)
    time = arranged.schema["time"].dataType
    fields = [*_fields(arranged, keys), *[T.StructField(t, time) for t in META[:3]]]
    fields += [T.StructField(n, T.LongType() if n == "n_points" else T.DoubleType()) for n in chosen]

    def make(rows: pa.Table, at: np.ndarray, view: np.ndarray) -> pa.Table:
        whole = ~np.isnan(view).any(1)
        at, x = at[whole], view[whole]
        times = rows.column("time")
        columns = [*(rows.column(k).take(at) for k in keys), times.take(at), times.take(at + size - 1), times.take(at + size // 2)]
        return pa.table([*columns, *feature_arrays(x, chosen, needed)], [f.name for f in fields])

    return _per_block(arranged, keys, size, step, rn, ROWS_PER_BLOCK, T.StructType(fields), make)


def rolling_means(arranged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Centred rolling means over 5 and 10 rows; rows without a full frame keep their value."""
    cut = blocks(number(arranged, keys), keys, before=5, after=4)
    at = block_window(keys)

    def centred(low: int, high: int):
        frame = at.rowsBetween(low, high)
        full = F.count("value").over(frame) == high - low + 1
        return F.when(full, F.avg("value").over(frame)).otherwise(F.col("value"))

    return own(cut.withColumns({"rolling_5": centred(-2, 2), "rolling_10": centred(-5, 4)}))


__all__ = [
    "BLOCK",
    "META",
    "MODEL_FEATURES",
    "complete",
    "extract_features",
    "long_enough",
    "rolling_means",
    "series_keys",
    "sliding_windows",
    "window_counts",
]
