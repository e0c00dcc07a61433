"""Synthetic faults in the test part of one series, for validation.

Everything random is derived from md5 of the row key, so a run can be repeated and checked.
A fault covers its own row and the rows after it; where faults overlap the one with the
higher number wins, and every fault starts from the original value of its row.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.columns import hash32, uniform
from sensorloom.operators.ordered import BLOCK, block_window, blocks, hash_rank, number, own
from sensorloom.session import freeze

# Fault type -> rows covered, constant shift, half width of the random shift.
FAULTS = {
    "point_spike": (1, 5.0, 0.0),
    "point_dip": (1, -5.0, 0.0),
    "collective_high": (60, 2.0, 0.0),
    "collective_low": (60, -2.0, 0.0),
    "stuck_sensor": (30, 0.0, 1.0),
    "high_noise": (30, 0.0, 3.0),
}
KEYS = ["entity_id", "split"]


def default_entity(readings: DataFrame) -> str | None:
    """The series that gets faults if none is named: the first in name order."""
    return readings.agg(F.min("entity_id")).first()[0]


def pick_events(arranged: DataFrame, entity: str, fraction: float, keys: Sequence[str] = KEYS) -> DataFrame:
    """Number the test rows of ``entity`` and mark a random share of them as fault starts.

    Adds ``rn``, and for the picked rows ``event_no`` (1..k in random order) and ``type``.
    """
    chosen = arranged.where((F.col("entity_id") == entity) & (F.col("split") == "test"))
    rows = number(chosen, keys, total="_n").withColumn("_u", hash32(F.col("row_key"), "pick"))
    ranked = hash_rank(rows, keys, "_u", "row_key", "_rank")
    picked = F.col("_rank") <= F.greatest(F.lit(1), F.floor(F.col("_n") * F.lit(float(fraction))))
    index = F.floor(uniform(F.col("row_key"), "type") * len(FAULTS)).cast("int") + 1
    kind = F.element_at(F.array(*[F.lit(f) for f in FAULTS]), index)
    return ranked.withColumns(
        {"event_no": F.when(picked, F.col("_rank")), "type": F.when(picked, kind)}
    ).drop("_u", "_n", "_rank")


def _random_shift(kind: str, row_key: Column) -> Column:
    half = FAULTS[kind][2]
    return uniform(row_key, kind) * F.lit(2 * half) - F.lit(half)


def _faulty(kind: Column, base: Column, start_key: Column, row_key: Column) -> Column:
    """Value of a covered row. Noise is drawn per row, the stuck value once per fault."""
    value = F.lit(None).cast("double")
    for name, (_, shift, half) in FAULTS.items():
        moved = base + F.lit(shift)
        if half:
            moved = moved + _random_shift(name, row_key if name == "high_noise" else start_key)
        value = F.when(kind == name, moved).otherwise(value)
    return value


def _by_length() -> dict[int, list[str]]:
    lengths: dict[int, list[str]] = {}
    for name, (rows, _, _) in FAULTS.items():
        lengths.setdefault(rows, []).append(name)
    return lengths


def inject_events(picked: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Overwrite covered rows: new ``value``, ``original_value`` and ``anomaly_label`` 0/1.

    The fault that rules a row is the highest-numbered one among the last 60, 30 or 1 rows,
    by fault length. That is a row frame over bounded blocks; no event is exploded or joined.
    """
    longest = max(_by_length())
    cut = blocks(picked, keys, before=longest - 1)
    at = block_window(keys)
    event = F.struct("event_no", "type", F.col("value").alias("base"), F.col("row_key").alias("start_key"))
    latest = [
        F.max(F.when(F.col("type").isin(names), event)).over(at.rowsBetween(1 - rows, 0))
        for rows, names in _by_length().items()
    ]
    ruled = own(cut.withColumn("_fault", F.greatest(*latest)))
    f = F.col("_fault")
    changed = _faulty(f["type"], f["base"], f["start_key"], F.col("row_key"))
    return (
        ruled.withColumn("original_value", F.col("value"))
        .withColumn("value", F.coalesce(changed, F.col("value")))
        .withColumn("anomaly_label", f.isNotNull().cast("int"))
        .drop("_fault")
    )


def injection_log(picked: DataFrame) -> DataFrame:
    """One row per fault with the value it gives to its own first row."""
    injected = _faulty(F.col("type"), F.col("value"), F.col("row_key"), F.col("row_key"))
    return picked.where("event_no is not null").select(
        "entity_id",
        "event_no",
        "rn",
        "type",
        "time",
        injected.alias("injected_value"),
        F.col("value").alias("original_value"),
    )


def injection_counts(picked: DataFrame) -> DataFrame:
    """Faults per type, most frequent first."""
    counted = picked.where("event_no is not null").groupBy("type").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "type")


def without_covered_events(picked: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Drop fault starts that lie inside an earlier-numbered fault (set difference of rows).

    The covered rows stay in the table, only without an event of their own.
    """
    longest = max(_by_length())
    cut = blocks(picked, keys, before=longest - 1)
    at = block_window(keys)
    first = [
        F.min(F.when(F.col("type").isin(names), F.col("event_no"))).over(at.rowsBetween(1 - rows, -1))
        for rows, names in _by_length().items()
        if rows > 1
    ]
    marked = own(cut.withColumn("_cover", F.least(*first)))
    free = F.coalesce(F.col("event_no") < F.col("_cover"), F.lit(True))
    return marked.withColumns(
        {"event_no": F.when(free, F.col("event_no")), "type": F.when(free, F.col("type"))}
    ).drop("_cover")


OPEN, KEPT, DROPPED = 0, 1, 2


def _decide(rows: pa.Table) -> pa.Table:
    """Status of the own events of a block, in row order; what hangs on an open event of the block before stays open."""
    rows = rows.sort_by("rn")
    names = ("rn", "event_no", "_rows", "_status", "_own")
    found, near = [], []
    for rn, event, length, status, mine in zip(*(rows.column(c).to_pylist() for c in names)):
        near = [e for e in near if e[0] >= rn]
        over = [s for _, n, s in near if n < event]
        if mine and status == OPEN:
            status = DROPPED if KEPT in over else OPEN if OPEN in over else KEPT
        near.append((rn + length - 1, event, status))
        found.append(status)
    own_rows = rows.set_column(rows.schema.get_field_index("_status"), "_status", pa.array(found, pa.int32())).filter(rows.column("_own"))
    return own_rows.drop_columns(["_own", BLOCK])


def without_overlaps(picked: DataFrame, keys: Sequence[str] = KEYS, rows_per_block: int = 2048) -> DataFrame:
    """Drop fault starts that lie inside a lower-numbered fault which is itself kept; other rows stay as they are.

    Whether a fault is kept hangs on faults that start up to 59 rows before it, and on theirs in turn. Only the
    starts are gathered, in blocks. A round decides all that hangs on decided ones; chains that cross a block's border
    take another round, so rounds follow the number of borders that a chain crosses and not the number of faults.
    """
    keys, longest = list(keys), max(_by_length())
    length = F.element_at(F.create_map(*[F.lit(x) for f, (n, _, _) in FAULTS.items() for x in (f, n)]), F.col("type"))
    events = picked.where("event_no is not null").select(*keys, "rn", "event_no", length.alias("_rows"), F.lit(OPEN).alias("_status"))
    events = freeze(events, "events")
    while True:
        cut = blocks(events, keys, before=longest - 1, rows=rows_per_block)
        events = freeze(cut.groupBy(*keys, BLOCK).applyInArrow(_decide, events.schema), "events")
        if events.where(F.col("_status") == OPEN).isEmpty():
            break
    kept = events.where(F.col("_status") == KEPT).select(*keys, "rn", F.lit(True).alias("_kept"))
    joined = picked.join(kept, [*keys, "rn"], "left")
    return joined.withColumns({c: F.when(F.col("_kept"), F.col(c)) for c in ("event_no", "type")}).drop("_kept")
