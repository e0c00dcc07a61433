"""Session helpers: UTC sessions, code on the executors, tables that cut lineage."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = Path(__file__).parent
        target = Path(tempfile.mkdtemp(prefix="package-")) / package.name
        sc.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
        _shipped.add(sc.applicationId)


def use_utc(spark: SparkSession) -> SparkSession:
    """All times are UTC instants; the session must agree."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, as named by the cluster.

    Only a local session without the setting gets a folder of its own: on a cluster a
    machine-local folder would be lost with its machine.
    """
    ship(spark)
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sensorloom-"))
    return sc.getCheckpointDir()


def freeze(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used where later steps must agree on a placement that Spark would otherwise sample
    again on recomputation, where a costly result is read more than once, and for summaries
    that are joined to a large table: Catalyst knows the size of a written table, so it plans
    a broadcast up to ``spark.sql.autoBroadcastJoinThreshold`` and does not shuffle the large
    side before it has seen how small the other one is.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for held in _scratches:
        held.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_scratches: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``freeze`` writes within the block when the block ends.

    Results that are read from them must have been stored or collected by then.
    """
    written: list[str] = []
    _scratches.append(written)
    try:
        yield
    finally:
        _scratches.remove(written)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in written:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
