"""Features of sliding row windows while the readings arrive.

One stateful operator per series puts rows in order: it holds readings until the watermark has passed them, then
numbers them and gives them out in chunks that begin with the last ``size - 1`` rows before (its ring). Chunks leave
the keyed operator and are spread over all tasks, where the features are computed as in the batch; a series with a third
of all readings is ordered in one task but not computed in one.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sensorloom.operators.windows import META, MODEL_FEATURES, feature_arrays, needed_groups
from sensorloom.streaming.live import prepare

CHUNK_ROWS = 2048
ROW = np.dtype([("t", "<i8"), ("row_key", "<i8"), ("value", "<f8")])  # a null value is NaN
CHUNK = "entity_id string, first_rn bigint, times array<bigint>, values array<double>"


class Cutter(StatefulProcessor):
    """State of a series: rows the watermark has not passed, the last ``size - 1`` rows given out, and their number.

    Rows are kept packed, one piece for each batch they came with, so a batch costs a few accesses and not one a row.
    """

    def __init__(self, size: int, chunk_rows: int):
        self.size, self.chunk_rows = size, chunk_rows

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        self.given = handle.getValueState("given", "n bigint, ring binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            if key[0] is None or not len(part):
                continue
            packed = np.zeros(len(part), ROW)
            for c in ROW.names:
                packed[c] = part[c].to_numpy()
            self.waiting.appendValue((packed.tobytes(),))
            least = int(packed["t"].min())
            first = least if first is None else min(first, least)
        if first is not None:
            self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = np.concatenate([np.zeros(0, ROW), *(np.frombuffer(r[0], ROW) for r in self.waiting.get())])
        waiting = waiting[np.lexsort((waiting["row_key"], waiting["t"]))]
        n = int(np.searchsorted(waiting["t"], passed, "right"))
        if not n:
            return
        if n < len(waiting):
            self.waiting.put([(waiting[n:].tobytes(),)])
            self._wake(int(waiting["t"][n]))
        else:
            self.waiting.clear()
        given, ring = self.given.get() if self.given.exists() else (0, b"")
        ring, halo = np.frombuffer(ring, ROW), self.size - 1
        rows = np.concatenate([ring, waiting[:n]])
        begins = given - len(ring) + 1  # number of the first row of ``rows``
        self.given.update((given + n, rows[max(0, len(rows) - halo) :].tobytes()))
        for at in range(0, max(0, len(rows) - halo), self.chunk_rows):
            part = rows[at : at + halo + self.chunk_rows]
            yield pd.DataFrame({"entity_id": [key[0]], "first_rn": [begins + at], "times": [part["t"]], "values": [part["value"]]})

    def close(self) -> None:
        pass

    def _wake(self, t: int) -> None:
        """At the first millisecond at which the watermark may have passed ``t``."""
        self.handle.registerTimer(-(-t // 1000))


def _features(size: int, step: int, chosen: Sequence[str]):
    needed = needed_groups(chosen)
    names = ["entity_id", *META[:3], *chosen]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for entity, first, times, values in zip(*(b.column(c) for c in ("entity_id", "first_rn", "times", "values"))):
                t = pa.array(times.values.to_numpy(), pa.int64()).cast(pa.timestamp("us", "UTC"))
                x = values.values.to_numpy(zero_copy_only=False).astype(float)
                view = np.lib.stride_tricks.sliding_window_view(x, size)
                at = np.flatnonzero(((first.as_py() - 1 + np.arange(len(view))) % step == 0) & ~np.isnan(view).any(1))
                who = pa.array([entity.as_py()] * len(at), pa.string())
                columns = [who, t.take(at), t.take(at + size - 1), t.take(at + size // 2), *feature_arrays(view[at], chosen, needed)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def stream_features(
    readings: DataFrame, size: int = 60, step: int = 1, names: Sequence[str] | None = None, delay: str = "1 hour", chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """A stream of window features: keys and times first, then the chosen features, as ``extract_features`` gives them.

    Windows count rows of a series in the order (time, row key), every ``step``-th row begins one, and windows with a null
    reading are left out. A window is given out once the watermark (latest time seen less ``delay``) has passed its last
    row; rows that arrive behind the watermark are dropped. Rows without a series only move the time on.
    """
    prepare(readings.sparkSession)
    # The operator is also set up in a process of the driver's own that does not get the files sent to the executors.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    chosen = [n for n in (names if names is not None else MODEL_FEATURES) if n not in ("entity_id", *META[:3])]
    timed = readings.withWatermark("time", delay).select("entity_id", "time", "row_key", "value", F.unix_micros("time").alias("t"))
    chunks = timed.groupBy("entity_id").transformWithStateInPandas(Cutter(size, chunk_rows), CHUNK, "append", "eventTime")
    spread = chunks.repartition(int(readings.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    schema = ["entity_id string", *(f"{t} timestamp" for t in META[:3]), *(f"`{n}` {'bigint' if n == 'n_points' else 'double'}" for n in chosen)]
    return spread.mapInArrow(_features(size, step, chosen), ", ".join(schema))
