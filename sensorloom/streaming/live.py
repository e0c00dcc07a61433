"""Readings as a stream of files: the source, the end of a stream, runs to a Parquet sink, late rows.

A stream reads ``readings`` rows (row_key, time, entity_id, value) that arrive as Parquet files. Rows may come
out of order by up to the ``delay`` of the operator's watermark; later ones are dropped and counted.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sensorloom.session import use_utc

READINGS = "row_key bigint, time timestamp, entity_id string, value double"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> None:
    """Session settings the streams of this package need.

    State is kept outside the heap, with changelogs as checkpoints. Sessions are merged in each task before they shuffle,
    so a device with a third of the readings sends one row a session and task.
    """
    use_utc(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")


def open_readings(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """The files of a folder, oldest first, as a stream."""
    prepare(spark)
    reader = spark.readStream.schema(READINGS)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def end_stream(spark: SparkSession, folder: str, time: dt.datetime) -> None:
    """Move the stream's time to ``time`` by a row that belongs to no series.

    Once it is a delay beyond the last reading, all that the operators still hold is given out.
    """
    spark.createDataFrame([(None, time, None, None)], READINGS).coalesce(1).write.mode("append").parquet(folder)


def run_available(stream: DataFrame, path: str, checkpoint: str, watch: Callable[[StreamingQuery], None] | None = None) -> int:
    """Process what is there, append the results to ``path``, and tell how many rows came too late.

    A later run with the same ``checkpoint`` goes on where this one, or one that died, has stopped. The sink's own log makes
    every result count once. A batch's progress is read as it ends, so no batch is missed however many there are.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path)
    query = writer.trigger(availableNow=True).start()
    if watch:
        watch(query)
    late: dict[int, int] = {}
    while True:
        done = query.awaitTermination(1)
        for p in query.recentProgress:
            late[p.batchId] = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        if done:
            return sum(late.values())


def results(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """What a stream has given out so far."""
    return spark.read.schema(like.schema).parquet(path)
