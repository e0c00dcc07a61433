"""Reading sources: CSV or Parquet files into the ``readings`` table.

readings(row_key bigint, time timestamp, equipment string, system string, entity_id string,
value double)
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.session import use_utc

# Accepted headers (fixed values): file column -> ours.
HEADERS = {
    "time": "time",
    "timestamp": "time",
    "EquipmentUnit": "equipment",
    "equipment_id": "equipment",
    "System": "system",
    "system_id": "system",
    "Oxygen[%sat]": "value",
    "oxygen_saturation": "value",
}

# Tried in turn after the ISO form (fixed values).
TIME_FORMATS = (
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd HH:mm",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "dd-MMM-yyyy HH:mm:ss",
)


class InputError(ValueError):
    """The input cannot be used: missing file, missing column, unreadable times or no rows."""


def parse_time(text: Column) -> Column:
    """ISO 8601 first (``T`` or space, ``Z`` or offset, up to nanoseconds), then other formats."""
    tried = [text.try_cast("timestamp"), *[F.try_to_timestamp(text, F.lit(f)) for f in TIME_FORMATS]]
    return F.coalesce(*tried)


def finite(number: Column) -> Column:
    """NaN and infinite numbers are missing readings: they become null."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def numeric(text: Column) -> Column:
    """Text that is no finite number becomes null."""
    return finite(text.try_cast("double"))


def entity_id(equipment: Column, system: Column) -> Column:
    """Routing key of a device stream; a missing part reads as the text ``nan``."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit("nan"))
    return F.concat(part(equipment), F.lit("_"), part(system))


def with_entity(df: DataFrame, global_if_missing: bool = False) -> DataFrame:
    """Add ``entity_id``; a table without both key columns is one series named ``global``."""
    if {"equipment", "system"} <= set(df.columns):
        return df.withColumn("entity_id", entity_id(F.col("equipment"), F.col("system")))
    if not global_if_missing:
        require_columns(df, ["equipment", "system"])
    return df.withColumn("entity_id", F.lit("global"))


def require_columns(df: DataFrame, names: list[str]) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise InputError(f"missing columns: {', '.join(missing)}")


def require_rows(df: DataFrame, what: str) -> None:
    if df.isEmpty():
        raise InputError(f"no rows in {what}")


def require_path(spark: SparkSession, path: str, fmt: str = "binaryFile") -> None:
    """Raise InputError for a path that holds no files, on any file system Spark can reach."""
    try:
        found = not spark.read.format(fmt).load(path).select("path").isEmpty()
    except Exception as e:
        raise InputError(f"cannot read {path}: {e}") from None
    if not found:
        raise InputError(f"no files at {path}")


def _renamed(df: DataFrame) -> DataFrame:
    picked = {}
    for source, name in HEADERS.items():
        if source in df.columns and name not in picked:
            picked[name] = F.col(f"`{source}`")
    return df.select(*[c.alias(n) for n, c in picked.items()])


def _by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files of a folder by their header; one short read per file, some at a time."""
    files = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]

    def header(file: str) -> tuple[str, ...]:
        return tuple(spark.read.option("header", True).csv(file).columns)

    with ThreadPoolExecutor(16) as pool:
        headers = list(pool.map(header, files))
    return {h: [f for f, g in zip(files, headers) if g == h] for h in dict.fromkeys(headers)}


def _read_csv(spark: SparkSession, path: str) -> Iterable[DataFrame]:
    """One table of texts per header; a file that does not have the header it was listed with fails."""
    for header, files in _by_header(spark, path).items():
        if header:  # a file without a line has none
            schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
            yield spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(files)


def _keyed(df: DataFrame) -> DataFrame:
    """``row_key`` from the row itself: the same row has the same key however the files are split or read.

    It breaks ties between readings of one device at one time. Rows that are equal in every column
    have equal keys and are interchangeable.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("time", "equipment", "system", "value") if c in df.columns]
    return df.withColumn("row_key", F.xxhash64(*parts))


def read_readings(
    spark: SparkSession, path: str, fmt: str = "csv", drop_nulls: bool = False, global_if_missing: bool = False
) -> DataFrame:
    """Scan a file or folder of readings; CSV files may differ in their headers and in column order.

    ``global_if_missing`` is the scoring form, which also accepts tables without device keys.
    """
    use_utc(spark)
    if fmt == "csv":
        require_path(spark, path)
        tables = [_renamed(t) for t in _read_csv(spark, path)]
        if not tables:
            raise InputError(f"no header in {path}")
        for t in tables:
            require_columns(t, ["time", "value"])
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    else:
        df = _renamed(spark.read.format(fmt).load(path))
        require_columns(df, ["time", "value"])
    return typed(_keyed(df), drop_nulls, global_if_missing)


def typed(df: DataFrame, drop_nulls: bool = False, global_if_missing: bool = False) -> DataFrame:
    """Parse text columns and add the entity key."""
    kinds = dict(df.dtypes)
    if kinds["time"] == "string":
        df = df.withColumn("time", parse_time(F.col("time")))
    elif kinds["time"] == "timestamp_ntz":
        df = df.withColumn("time", F.col("time").cast("timestamp"))
    if kinds["value"] == "string":
        df = df.withColumn("value", numeric(F.col("value")))
    else:
        df = df.withColumn("value", finite(F.col("value").cast("double")))
    df = with_entity(df, global_if_missing)
    return df.where("value is not null") if drop_nulls else df


def check_times(df: DataFrame) -> DataFrame:
    """Raise InputError if a reading has no usable time."""
    bad = df.where("time is null").count()
    if bad:
        raise InputError(f"{bad} readings have no readable time")
    return df


# Expressions over the events table (value variants used by tests and registered queries).
EVENT_VALUES = {
    "plain": "value",
    "nulls": "case when event_id % 17 = 0 then null else value end",
    "stuck": "case when (event_id div 1000) % 4 = 1 then 95.0d else 90.0d + floor(least(value, 100.0d) / 10) end",
    "bad_text": "case event_id % 23 when 0 then 'n/a' when 1 then 'NaN' when 2 then 'inf' when 3 then '-Infinity' else cast(value as string) end",
    "nan": "case event_id % 17 when 0 then null when 1 then double('NaN') when 2 then double('-Infinity') else value end",
}


def read_events(spark: SparkSession, sf_dir: str, variant: str = "plain") -> DataFrame:
    """The ``events`` table as readings of ten devices."""
    use_utc(spark)
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    df = events.select(
        F.col("event_id").alias("row_key"),
        F.col("ts").alias("time"),
        F.expr("concat('EQ', user_id % 2)").alias("equipment"),
        F.col("event_type").alias("system"),
        F.expr(EVENT_VALUES[variant]).alias("value"),
    )
    return typed(df)
