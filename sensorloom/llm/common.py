"""What the operators share: texts as byte arrays, bounded batches, joins with hot classes.

Row rules of the whole subpackage: a null text counts as the empty text, a null id is larger than
any other id, and columns that an operator does not use pass through it under their own names.
"""

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import words

NULL_ID = 2**63 - 1
#: Texts are handled in slices of about so many bytes; a longer text makes a slice of its own.
SLICE_BYTES = 2 << 20
#: A class with more than 1/HOT of all rows is hot, so at most HOT classes are.
HOT = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_of(name: str) -> Column:
    """The id as a number without nulls; ``id_back`` is the way back."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NULL_ID))


def id_back(name: str) -> Column:
    return F.when(F.col(name) != NULL_ID, F.col(name))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES):
    """Cut a record batch into runs of rows with about ``limit`` bytes of text."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths, dtype=np.int64)
    first = 0
    while first < len(lengths):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(first, last - first)
        first = last


def release() -> None:
    """Give freed memory back to the machine: a Python worker keeps waiting beside others after its task."""
    words.forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def flat_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of bytes, and the n + 1 places where they begin and end."""
    col = texts.fill_null("").cast(pa.large_binary())
    _, places, data = col.buffers()
    offsets = np.frombuffer(places, np.int64)[col.offset : col.offset + len(col) + 1]
    if data is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def hot_keys(classes: DataFrame, key: str, size: str) -> DataFrame:
    """Keys of the classes with over 1/HOT of all rows; at most HOT rows by that definition."""
    total = classes.agg(F.sum(size)).first()[0] or 0
    return classes.where(F.col(size) > total / HOT).select(key)


def join_classes(rows: DataFrame, classes: DataFrame, key: str, size: str, spread_by: str) -> DataFrame:
    """Inner join of many ``rows`` with one row a class.

    A class may hold a third of all rows. Rows of hot classes are spread by a salt, their class
    rows are repeated once a salt; the list of hot keys is all that is broadcast.
    """
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(classes, key, size).withColumn("_hot", F.lit(True))
    salt = F.pmod(F.xxhash64(spread_by), F.lit(salts))
    left = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(0)).drop("_hot")
    every = F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))
    right = classes.join(F.broadcast(hot), key, "left").withColumn(
        "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0).cast("long"))))
    )
    return left.join(right.drop("_hot"), [key, "_salt"]).drop("_salt")
