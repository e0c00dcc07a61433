"""Ordered operators that never put a whole series into one task.

A window over ``partitionBy(series)`` sends a series to one task, and one device may own a
third of all readings. Here a table is range-partitioned on (keys, order) instead, so that a
long series spans many *chunks* of about equal size. Whatever must cross a chunk border is
carried by a summary with one row per (series, chunk):

* row numbers: rows in earlier chunks + position inside the chunk,
* running sums, previous row, last/next non-null value: chunk-local window + carry.

The order columns should end in a unique key, so that equal times can be split as well.
These operators read their input twice, for the summary and for the rows. Give them a written
table: chained without one, every step would double the work before it.

With exact row numbers, ``blocks`` cuts series into groups of a fixed number of rows plus the
neighbours a row frame needs; these groups are bounded whatever the skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.session import freeze

CHUNK = "_chunk"
POS = "_pos"
BLOCK = "_block"
_POSITION_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def arrange(df: DataFrame, keys: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Sort by (keys, order) across the cluster and write the placement down.

    Range borders come from a sample, so the placement is written to the shared folder before
    anything is counted on it. Without ``partitions`` AQE picks the number of chunks by size.
    """
    cols = [*keys, *order]
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    placed = (
        ranged.sortWithinPartitions(*cols)
        .withColumn(POS, F.monotonically_increasing_id())
        .withColumn(CHUNK, F.shiftright(POS, _POSITION_BITS))
    )
    return freeze(placed, "arranged")


def _joined(df: DataFrame, summary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the carry of each (series, chunk).

    The windows of the callers need the rows by (series, chunk) as well, so where the summary
    is too large to broadcast the join and the window share one shuffle.
    """
    return df.join(summary, [*keys, CHUNK])


# Backward frames are written as forward frames over the reverse order: a frame that ends at
# UNBOUNDED FOLLOWING is evaluated anew for every row, a growing one is updated.


def _earlier(keys: Sequence[str], ahead: bool = True):
    return Window.partitionBy(*(keys or [F.lit(0)])).orderBy(CHUNK if ahead else F.desc(CHUNK))


def local_window(keys: Sequence[str], ahead: bool = True):
    return Window.partitionBy(*keys, CHUNK).orderBy(POS if ahead else F.desc(POS))


def number(arranged: DataFrame, keys: Sequence[str], out: str = "rn", total: str | None = None) -> DataFrame:
    """1-based row number within ``keys`` (any refinement of the arranged keys by order).

    Only the summary is aggregated and written; the rows themselves are not shuffled unless
    the summary outgrows a broadcast.
    """
    spans = arranged.groupBy(*keys, CHUNK).agg(F.min(POS).alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(_earlier(keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = [*keys, CHUNK, (F.col("_first") - before).alias("_shift")]
    if total:
        kept.append(F.sum("_n").over(Window.partitionBy(*(keys or [F.lit(0)]))).alias(total))
    numbered = _joined(arranged, freeze(spans.select(*kept), "spans"), keys)
    return numbered.withColumn(out, F.col(POS) - F.col("_shift") + 1).drop("_shift")


def running_sum(arranged: DataFrame, keys: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Inclusive running sums within ``keys``; ``sums`` maps output names to expressions."""
    named = arranged.select("*", *[e.alias(f"_v_{o}") for o, e in sums.items()])
    parts = named.groupBy(*keys, CHUNK).agg(*[F.sum(f"_v_{o}").alias(f"_s_{o}") for o in sums])
    earlier = _earlier(keys).rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select(
        *keys, CHUNK, *[F.coalesce(F.sum(f"_s_{o}").over(earlier), F.lit(0)).alias(f"_c_{o}") for o in sums]
    )
    local = local_window(keys).rowsBetween(Window.unboundedPreceding, 0)
    out = _joined(named, carry, keys)
    out = out.withColumns({o: F.col(f"_c_{o}") + F.coalesce(F.sum(f"_v_{o}").over(local), F.lit(0)) for o in sums})
    return out.drop(*[f"_c_{o}" for o in sums], *[f"_v_{o}" for o in sums])


def previous(arranged: DataFrame, keys: Sequence[str], cols: dict[str, str]) -> DataFrame:
    """Value of the preceding row within ``keys``; ``cols`` maps output names to input columns."""
    last = F.max_by(F.struct(*[F.col(c).alias(o) for o, c in cols.items()]), POS)
    tails = arranged.groupBy(*keys, CHUNK).agg(last.alias("_last"))
    carry = tails.select(*keys, CHUNK, F.lag("_last").over(_earlier(keys)).alias("_carry"))
    at = local_window(keys)
    first = F.row_number().over(at) == 1
    out = _joined(arranged, carry, keys).withColumns(
        {o: F.when(first, F.col("_carry")[o]).otherwise(F.lag(c).over(at)) for o, c in cols.items()}
    )
    return out.drop("_carry")


def fill(
    arranged: DataFrame,
    keys: Sequence[str],
    forward: dict[str, str] | None = None,
    backward: dict[str, str] | None = None,
) -> DataFrame:
    """Nearest non-null value at or before (``forward``) and at or after (``backward``) each row.

    Both map output names to input columns; both directions take one pass.
    """
    wanted = [(o, c, True) for o, c in (forward or {}).items()] + [(o, c, False) for o, c in (backward or {}).items()]
    ends, carried, filled = [], [], {}
    for o, c, ahead in wanted:
        pick = F.max_by if ahead else F.min_by
        beyond = _earlier(keys, ahead).rowsBetween(Window.unboundedPreceding, -1)
        within = local_window(keys, ahead).rowsBetween(Window.unboundedPreceding, 0)
        ends.append(pick(c, F.when(F.col(c).isNotNull(), F.col(POS))).alias(f"_e_{o}"))
        carried.append(F.last(f"_e_{o}", ignorenulls=True).over(beyond).alias(f"_c_{o}"))
        filled[o] = F.coalesce(F.last(c, ignorenulls=True).over(within), F.col(f"_c_{o}"))
    carry = arranged.groupBy(*keys, CHUNK).agg(*ends).select(*keys, CHUNK, *carried)
    return _joined(arranged, carry, keys).withColumns(filled).drop(*[f"_c_{o}" for o, _, _ in wanted])


def blocks(
    numbered: DataFrame,
    keys: Sequence[str],
    rn: str = "rn",
    before: int = 0,
    after: int = 0,
    rows: int = 2048,
    partitions: int | None = None,
) -> DataFrame:
    """Cut series into blocks of ``rows`` rows, adding up to ``before``/``after`` neighbour rows.

    A row belongs to block ``(rn-1) div rows`` (see ``own``) and is copied to a neighbouring
    block where frames need it. One shuffle on (keys, block); group size is at most
    ``rows + before + after``.
    """
    rows = max(rows, before, after, 1)
    low = F.expr(f"greatest(0, {rn} - 1 - {after}) div {rows}")
    high = F.expr(f"({rn} - 1 + {before}) div {rows}")
    copied = numbered.drop(POS, CHUNK).withColumn(BLOCK, F.explode(F.sequence(low, high)))
    copied = copied.withColumn("_own", F.expr(f"({rn} - 1) div {rows}") == F.col(BLOCK))
    spread = [*keys, BLOCK]
    # Frames are CPU-heavy on small bytes: keep the configured parallelism instead of letting
    # AQE merge the partitions by size.
    n = partitions or int(numbered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return copied.repartition(n, *spread)


def block_window(keys: Sequence[str], rn: str = "rn"):
    return Window.partitionBy(*keys, BLOCK).orderBy(rn)


def own(blocked: DataFrame) -> DataFrame:
    """Drop the copied neighbour rows again."""
    return blocked.where("_own").drop("_own", BLOCK)


HASH_BUCKETS = 1 << 16


def hash_rank(df: DataFrame, keys: Sequence[str], u: str, tie: str, out: str = "hash_rank") -> DataFrame:
    """1-based rank within ``keys`` by a 32-bit hash column ``u`` (ties by ``tie``).

    Buckets of the hash are even by construction, so the local rank is taken per bucket and
    the counts of earlier buckets are added; no series is ordered in one task.
    """
    bucketed = df.withColumn("_bucket", F.expr(f"{u} div {(1 << 32) // HASH_BUCKETS}"))
    counts = bucketed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    at = Window.partitionBy(*keys, "_bucket").orderBy(u, tie)
    ranked = bucketed.join(offsets, [*keys, "_bucket"])
    return ranked.withColumn(out, F.row_number().over(at) + F.col("_before")).drop("_bucket", "_before")
