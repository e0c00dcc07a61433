"""Windows of a stretch of time instead of a number of rows.

A window ends at each time at which a series has a reading and holds all readings of the ``minutes`` before. How many
those are is not bounded: one minute may hold a third of all rows. So no window is ever gathered. Readings of equal time
become one entry; entries are numbered and cut into blocks. A window inside a block is answered there. One that reaches
further back is put together from the end of the block it begins in, the blocks between, and the beginning of its own.

* Where a window begins, and the statistics from there to the end of that block, come from an ordered pass over the
  entries and the windows' begins (a fill, so a place where very many windows begin is not a hot key).
* Blocks between are ranges over block totals: the same problem on a table smaller by the block size, solved in the same
  way, level by level (``range_stats``).

Statistics (count, mean, squared deviations, minimum, maximum) are only ever merged, never subtracted, so a quiet
stretch beside large values keeps its digits.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.operators.ordered import CHUNK, POS, arrange, fill, number
from sensorloom.session import freeze

ROWS_PER_BLOCK = 2048
STATS = ("n", "mean", "dev", "low", "high")  # dev: summed squared deviations from the mean
EMPTY = (0.0, 0.0, 0.0, np.inf, -np.inf)


# ---------------------------------------------------------------- statistics in a task

Stats = tuple[np.ndarray, ...]


def merge(a: Stats, b: Stats) -> Stats:
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    apart = b[1] - a[1]
    return n, a[1] + apart * share, a[2] + b[2] + apart * apart * a[0] * share, np.minimum(a[3], b[3]), np.maximum(a[4], b[4])


class Tree:
    """Statistics of any range of entries from merged pairs, pairs of pairs, and so on."""

    def __init__(self, leaves: Stats):
        size = 1
        while size < len(leaves[0]):
            size *= 2
        self.size = size
        self.nodes = [np.full(2 * size, e) for e in EMPTY]
        for node, leaf in zip(self.nodes, leaves):
            node[size : size + len(leaf)] = leaf
        while size > 1:
            pairs = merge(tuple(x[size : 2 * size : 2] for x in self.nodes), tuple(x[size + 1 : 2 * size : 2] for x in self.nodes))
            for node, p in zip(self.nodes, pairs):
                node[size // 2 : size] = p
            size //= 2

    def query(self, first: np.ndarray, last: np.ndarray) -> Stats:
        """Statistics of the entries ``first`` to ``last`` (both included) of many ranges at once."""
        left, right = first + self.size, last + self.size + 1
        found = tuple(np.full(len(first), e) for e in EMPTY)
        pick = lambda where, at: tuple(np.where(where, x[np.minimum(at, 2 * self.size - 1)], e) for x, e in zip(self.nodes, EMPTY))
        while (left < right).any():
            odd = (left < right) & (left % 2 == 1)
            found = merge(found, pick(odd, left))
            left = left + odd
            odd = (left < right) & (right % 2 == 1)
            right = right - odd
            found = merge(found, pick(odd, right))
            left, right = left // 2, right // 2
        return found


def _stats_of(rows: pa.Table, prefix: str = "") -> Stats:
    return tuple(rows.column(prefix + c).to_numpy().astype(float) for c in STATS)


def _columns(stats: Stats) -> list[pa.Array]:
    return [pa.array(x, pa.float64()) for x in stats]


# ---------------------------------------------------------------- statistics as columns


def _plain(prefix: str = "") -> list[Column]:
    return [F.col(prefix + c).alias(c) for c in STATS]


def merged(a: Column, b: Column) -> Column:
    """The same merge of two structs in Spark."""
    n = a["n"] + b["n"]
    share = F.coalesce(F.try_divide(b["n"], n), F.lit(0.0))
    apart = b["mean"] - a["mean"]
    return F.struct(
        n.alias("n"),
        (a["mean"] + apart * share).alias("mean"),
        (a["dev"] + b["dev"] + apart * apart * a["n"] * share).alias("dev"),
        F.least(a["low"], b["low"]).alias("low"),
        F.greatest(a["high"], b["high"]).alias("high"),
    )


def _fields(df: DataFrame, names: Sequence[str]) -> list[T.StructField]:
    return [df.schema[c] for c in names]


def _doubles(prefix: str = "") -> list[T.StructField]:
    return [T.StructField(prefix + c, T.DoubleType()) for c in STATS]


def range_stats(nodes: DataFrame, asked: DataFrame, keys: Sequence[str], rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Statistics (keys, first, last, stats struct) of ranges of numbered entries.

    ``nodes`` holds (keys, i, statistics) with i from 0, ``asked`` different (keys, first, last). A range within a block is
    answered there; others by the ends of their outer blocks (few different ones a block) and, between, by block totals.
    """
    size = rows_per_block
    blocks = asked.withColumns({"_a": F.expr(f"first div {size}"), "_z": F.expr(f"last div {size}")})
    piece = lambda block, a, z: F.struct(block.alias("block"), a.alias("a"), z.alias("z"))
    first, last, a, z = (F.col(c) for c in ("first", "last", "_a", "_z"))
    ends = F.array(piece(a, first, a * size + (size - 1)), piece(z, z * size, last))
    cut = blocks.select(*keys, "first", "last", F.explode(F.when(a == z, F.array(piece(a, first, last))).otherwise(ends)).alias("p"))
    cut = freeze(cut.select(*keys, "first", "last", "p.*"), "pieces")
    place = [*keys, "block"]
    placed = nodes.withColumn("block", F.expr(f"i div {size}"))
    fields = [*_fields(placed, keys), T.StructField("a", T.LongType()), T.StructField("z", T.LongType()), *_doubles()]

    def answer(rows: pa.Table, requests: pa.Table) -> pa.Table:
        if not requests.num_rows or not rows.num_rows:
            return pa.Table.from_batches([], pa.schema([pa.field(f.name, requests.schema.field(f.name).type if f.name in requests.schema.names else pa.float64()) for f in fields]))
        rows = rows.sort_by("i")
        begin = rows.column("i")[0].as_py()
        tree = Tree(_stats_of(rows))
        a, z = (requests.column(c).to_numpy() - begin for c in ("a", "z"))
        found = tree.query(a, np.minimum(z, rows.num_rows - 1))
        return pa.table([*(requests.column(f.name) for f in fields[: len(keys) + 2]), *_columns(found)], [f.name for f in fields])

    requests = cut.select(*place, "a", "z").distinct()
    answered = placed.groupBy(*place).cogroup(requests.groupBy(*place)).applyInArrow(answer, T.StructType(fields))
    parts = cut.join(answered, [*keys, "a", "z"]).select(*keys, "first", "last", F.struct(*STATS).alias("part"))
    between = blocks.where(z - a > 1).select(*keys, "first", "last", (a + 1).alias("_first"), (z - 1).alias("_last"))
    if not between.isEmpty():
        wider = placed.groupBy(*place).applyInArrow(_block_total(keys), T.StructType([*_fields(placed, place), *_doubles()]))
        inner = range_stats(
            freeze(wider.withColumnRenamed("block", "i"), "totals"), between.select(*keys, F.col("_first").alias("first"), F.col("_last").alias("last")).distinct(), keys, size
        )
        inner = inner.select(*keys, F.col("first").alias("_first"), F.col("last").alias("_last"), F.col("stats").alias("part"))
        parts = parts.unionByName(between.join(inner, [*keys, "_first", "_last"]).select(*keys, "first", "last", "part"))
    # At most three parts a range.
    together = parts.groupBy(*keys, "first", "last").agg(F.collect_list("part").alias("parts"))
    none = F.struct(*[F.lit(e).alias(c) for c, e in zip(STATS, EMPTY)])
    return together.select(*keys, "first", "last", F.aggregate("parts", none, merged).alias("stats"))


def _block_total(keys: Sequence[str]):
    def run(rows: pa.Table) -> pa.Table:
        tree = Tree(_stats_of(rows))
        whole = tree.query(np.array([0]), np.array([rows.num_rows - 1]))
        return pa.table([*(rows.column(c).slice(0, 1) for c in [*keys, "block"]), *_columns(whole)], [*keys, "block", *STATS])

    return run


# ---------------------------------------------------------------- windows


def _within_blocks(entries: DataFrame, keys: Sequence[str], span_us: int) -> DataFrame:
    """For each entry its window as far as it lies in its block, whether it may reach further, and what follows in the block."""
    kept = [*keys, "time", "rn", "block"]
    fields = [*_fields(entries, kept), T.StructField("reaches", T.BooleanType()), *_doubles(), *_doubles("rest_")]

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("rn")
        t = rows.column("time").cast(pa.int64()).to_numpy()
        tree, at = Tree(_stats_of(rows)), np.arange(len(t))
        first = np.searchsorted(t, t - span_us, "left")
        window, rest = tree.query(first, at), tree.query(at, np.full(len(t), len(t) - 1))
        return pa.table([*(rows.column(c) for c in kept), pa.array(first == 0), *_columns(window), *_columns(rest)], [f.name for f in fields])

    return entries.groupBy(*keys, "block").applyInArrow(run, T.StructType(fields))


def time_windows(readings: DataFrame, keys: Sequence[str], minutes: float, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """(keys, window_end, n_points, mean, std, min, max) for each different time of a series.

    The window holds the readings from ``minutes`` before its end to its end, both included, and with them all that share its
    end. Null readings do not count; a window without any has zero points and nulls. The deviation is that of
    the population, and zero if all values are equal.
    """
    span_us = round(minutes * 60_000_000)
    values = readings.groupBy(*keys, "time").agg(
        F.count("value").cast("double").alias("n"), F.avg("value").alias("mean"), F.var_pop("value").alias("dev"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    filled = dict(zip(STATS, EMPTY))
    filled = {c: F.coalesce(F.col("n") * F.col(c) if c == "dev" else F.col(c), F.lit(e)) for c, e in filled.items()}
    entries = number(arrange(values.withColumns(filled), keys, ["time"]), keys).drop(POS, CHUNK)
    entries = entries.withColumn("block", F.expr(f"(rn - 1) div {rows_per_block}"))
    local = freeze(_within_blocks(entries, keys, span_us), "blocks")
    reaching = F.col("reaches") & (F.col("block") > 0)
    done = local.where(~reaching).select(*keys, F.col("time").alias("window_end"), F.struct(*_plain()).alias("stats"))

    # The entry at which a reaching window begins is the next one at or behind the window's first instant.
    here = F.struct("rn", *[F.col(f"rest_{c}").alias(c) for c in STATS])
    places = local.select(*keys, "time", F.lit(1).alias("_kind"), "rn", here.alias("_here"))
    begins = local.where(reaching).select(
        *keys,
        F.timestamp_micros(F.unix_micros("time") - span_us).alias("time"),
        F.lit(0).alias("_kind"),
        "rn",
        F.struct("time", "block", F.struct(*_plain()).alias("stats")).alias("_window"),
    )
    order = arrange(begins.unionByName(places, allowMissingColumns=True), keys, ["time", "_kind", "rn"])
    met = fill(order, keys, backward={"_next": "_here"}).where("_kind = 0")
    begun = met.select(*keys, "_window.*", F.expr(f"(_next.rn - 1) div {rows_per_block}").alias("from_block"), F.struct(*[F.col("_next")[c].alias(c) for c in STATS]).alias("rest"))
    begun = freeze(begun, "begun")
    both = F.when(F.col("from_block") < F.col("block"), merged(F.col("rest"), F.col("stats"))).otherwise(F.col("stats"))
    joined = begun.withColumn("stats", both)
    between = begun.where("block - from_block > 1").select(*keys, (F.col("from_block") + 1).alias("first"), (F.col("block") - 1).alias("last"))
    if not between.isEmpty():
        totals = local.where(F.expr(f"(rn - 1) % {rows_per_block} = 0")).select(*keys, F.col("block").alias("i"), *_plain("rest_"))
        inner = range_stats(totals, freeze(between.distinct(), "between"), keys, rows_per_block).withColumnRenamed("stats", "middle")
        joined = joined.withColumns({"first": F.col("from_block") + 1, "last": F.col("block") - 1}).join(inner, [*keys, "first", "last"], "left")
        joined = joined.withColumn("stats", F.when(F.col("middle").isNotNull(), merged(F.col("middle"), F.col("stats"))).otherwise(F.col("stats")))
    table = done.unionByName(joined.select(*keys, F.col("time").alias("window_end"), "stats"))
    s = F.col("stats")
    known = lambda x: F.when(s["n"] > 0, x)
    flat = s["low"] == s["high"]
    return table.select(
        *keys,
        "window_end",
        s["n"].cast("bigint").alias("n_points"),
        known(F.when(flat, s["low"]).otherwise(s["mean"])).alias("mean"),
        known(F.when(flat, 0.0).otherwise(F.sqrt(F.try_divide(s["dev"], s["n"])))).alias("std"),
        known(s["low"]).alias("min"),
        known(s["high"]).alias("max"),
    )


__all__ = ["Tree", "merge", "merged", "range_stats", "time_windows"]
