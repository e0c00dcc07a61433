"""Integer vectors, their exact distances, and tables that are rewritten in rounds.

Used by the two operators that move centres over the vectors in rounds. All components become integers
within ``LIMIT``, so distances, sums and means are exact and do not depend on how rows are split.
"""

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.session import shared_dir, ship

#: Largest component, so that squared distances of up to 64 components fit a long.
LIMIT = 1 << 27


def finite(vector: str) -> Column:
    """True for vectors that are not null and hold neither null nor non-finite components."""
    v = F.col(vector)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(v.isNotNull() & good, F.lit(False))


def floored(vector: str, scale: int) -> Column:
    """floor(scale * x) of each component; a component beyond ``LIMIT`` fails the job with a message."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    fits = F.forall(whole, lambda x: x.between(-LIMIT, LIMIT))
    return F.when(fits, whole.cast("array<int>")).otherwise(F.raise_error(F.lit(f"a component times {scale} is beyond {LIMIT}")).cast("array<int>"))


def matrix(column: pa.Array, width: int, kind=np.int64) -> np.ndarray:
    """A list column, every list of the same length, as one array with a row each."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rows.reshape(-1), kind))


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row of ``x`` to every row of ``c``, all integers.

    Products of doubles are exact while all sums stay below 2^53; larger numbers are subtracted as integers.
    """
    most = int(max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)))
    if 4 * most * most * max(1, x.shape[1]) < 1 << 53:
        y, d = x.astype(np.float64), c.astype(np.float64)
        return ((y * y).sum(1)[:, None] + (d * d).sum(1)[None] - 2 * (y @ d.T)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in c], axis=1) if len(c) else np.zeros((len(x), 0), np.int64)


def own_distances(x: np.ndarray, c: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row of ``x`` to its row ``at`` of ``c``."""
    return ((x - c[at]) ** 2).sum(1)


def root_down(square: np.ndarray) -> np.ndarray:
    """Largest integers whose squares are not above the given integers."""
    r = np.sqrt(square.astype(np.float64)).astype(np.int64)
    r -= r * r > square
    return r + ((r + 1) * (r + 1) <= square)


def root_up(square: np.ndarray) -> np.ndarray:
    r = root_down(square)
    return r + (r * r < square)


def floor_means(sums: np.ndarray, n: np.ndarray, before: np.ndarray) -> np.ndarray:
    """floor(sum / n) by component; centres without rows stay."""
    return np.where((n > 0)[..., None], sums // np.maximum(n, 1)[..., None], before)


class Rounds:
    """A table in the shared folder that is replaced by its successor; the one before is then deleted."""

    def __init__(self, name: str):
        self.name, self.path = name, None

    def write(self, df: DataFrame) -> DataFrame:
        spark, before = df.sparkSession, self.path
        ship(spark)
        self.path = f"{shared_dir(spark)}/{self.name}-{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        if before:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(before)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        return spark.read.schema(df.schema).parquet(self.path)
