"""Approximate nearest neighbours over shifted space-filling curves.

Each curve orders the vectors by a Hilbert key of a few random projections, on a grid of equal-count
cells that is shifted by a random amount. Rows are range-partitioned along every curve; a query reads
the window of keys around its own on each, and the candidates of all curves are merged and reranked
by their true distance.

The grids, the ranges and the width of the window are fitted on a bounded sample: the window is the
smallest share of the rows with which a sample search reaches ``TARGET`` recall. Every row is
indexed. Vectors with clear neighbours need narrow windows; directions that are all alike (noise on a
sphere) need a constant share of the rows on any curve.

Equal vectors are one class on the curves, with its smallest ids, so a vector that a third of all rows
hold is one point there.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm.common import id_back, id_of, join_classes
from sensorloom.llm.hilbert import hilbert_keys
from sensorloom.session import freeze, ship

CURVES = 16
PROJECTIONS = 8
CELL_BITS = 5
#: Vectors that the index is fitted on, at most; and the queries among them that choose the window.
SAMPLE_ROWS = 8192
SAMPLE_QUERIES = 256
TARGET = 0.96
SHARES = (1 / 256, 1 / 128, 1 / 64, 3 / 128, 1 / 32, 3 / 64, 1 / 16, 3 / 32, 1 / 8, 3 / 16, 1 / 4, 3 / 8, 1 / 2, 1.0)
#: Rows, and queries, that meet in one task at a time.
UNIT_ROWS = 4096
UNIT_QUERIES = 1024


@dataclass
class Index:
    projections: np.ndarray  # curve, dimension, projection
    cells: np.ndarray  # curve, projection, inner borders of the cells
    shifts: np.ndarray
    keys: list[np.ndarray]  # for each curve the sorted keys of the sample
    share: float

    def key(self, curve: int, vectors: np.ndarray) -> np.ndarray:
        y = vectors @ self.projections[curve]
        cells = [np.searchsorted(self.cells[curve, j], y[:, j]) for j in range(y.shape[1])]
        return hilbert_keys(np.stack(cells, axis=1) + self.shifts[curve], CELL_BITS + 1)

    def rank(self, curve: int, keys: np.ndarray) -> np.ndarray:
        """Share of the sample before each key."""
        return np.searchsorted(self.keys[curve], keys) / max(1, len(self.keys[curve]))


def build_index(sample: np.ndarray, k: int, curves: int = CURVES, target: float = TARGET, seed: int = 5) -> Index:
    """Fit the curves and the window on sampled vectors (a row each)."""
    rng, dim = np.random.default_rng(seed), sample.shape[1]
    p = min(PROJECTIONS, dim)
    projections = np.stack([np.linalg.qr(rng.normal(size=(dim, p)))[0] for _ in range(curves)])
    inner = np.linspace(0, 1, (1 << CELL_BITS) + 1)[1:-1]
    cells = np.stack([np.quantile(sample @ projections[c], inner, axis=0).T for c in range(curves)])
    shifts = rng.integers(0, 1 << CELL_BITS, (curves, p))
    index = Index(projections, cells, shifts, [], 1.0)
    keys = [index.key(c, sample) for c in range(curves)]
    index.keys = [np.sort(x) for x in keys]
    asked = rng.permutation(len(sample))[:SAMPLE_QUERIES]
    square = (sample**2).sum(axis=1)
    d = square[None] + square[asked, None] - 2 * sample[asked] @ sample.T
    d[np.arange(len(asked)), asked] = np.inf
    near = np.argsort(d, axis=1)[:, : min(k, len(sample) - 1)]
    ranks = [index.rank(c, keys[c]) for c in range(curves)]
    gap = np.min([np.abs(r[near] - r[asked][:, None]) for r in ranks], axis=0) if near.size else np.zeros((1, 1))
    index.share = next(s for s in SHARES if (gap <= s).mean() >= target or s == 1.0)
    return index


def _places(sent, blocks: int, queries: int, salts: int):
    """For each vector: the (curve, block) where it lies, and for a query those of its windows."""

    def run(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        index = sent.value
        for vectors, asks, salt in batches:
            x = _matrix(vectors)
            asks, salt = asks.to_numpy(zero_copy_only=False), salt.to_numpy()
            row, unit, part, role = [], [], [], []

            def add(who, block, s, t, is_query):
                row.append(who)
                unit.append(block)
                part.append(s * queries + t)
                role.append(np.full(len(who), is_query))

            for c in range(len(index.keys)):
                rank = index.rank(c, index.key(c, x)) if len(x) else np.zeros(0)
                block = np.minimum((rank * blocks).astype(np.int64), blocks - 1)
                everyone = np.arange(len(x))
                for t in range(queries):
                    add(everyone, c * blocks + block, salt % salts, t, False)
                low = np.maximum(((rank - index.share) * blocks).astype(np.int64), 0)
                high = np.minimum(((rank + index.share) * blocks).astype(np.int64), blocks - 1)
                for far in range(int((high - low).max(initial=-1)) + 1):
                    who = np.flatnonzero(asks & (low + far <= high))
                    for s in range(salts):
                        add(who, c * blocks + low[who] + far, np.full(len(who), s), salt[who] % queries, True)
            row = np.concatenate(row)
            order = np.argsort(row, kind="stable")
            n = np.bincount(row, minlength=len(x))
            fields = [pa.array(np.concatenate(a)[order]) for a in (unit, part, role)]
            values = pa.StructArray.from_arrays([fields[0].cast(pa.int64()), fields[1].cast(pa.int64()), fields[2]], ["unit", "part", "asks"])
            yield pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), values)

    return F.arrow_udf(run, "array<struct<unit:bigint,part:bigint,asks:boolean>>")


def _matrix(vectors: pa.Array) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else np.zeros((0, 1))


def _nearest(k: int):
    """Of one unit: the k nearest classes of each query, and all at the distance of the last."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        asks = rows.column("asks").to_numpy(zero_copy_only=False)
        x, ids = _matrix(rows.column("v")), rows.column("least").to_numpy()
        q, asking, held, theirs = x[asks], ids[asks], x[~asks], ids[~asks]
        out_q, out_c, out_d = [], [], []
        square = (held**2).sum(axis=1)
        for i in range(0, len(q) if len(held) else 0, 256):
            own = q[i : i + 256]
            d = square[None] + (own**2).sum(axis=1)[:, None] - 2 * own @ held.T
            kth = np.partition(d, min(k, d.shape[1]) - 1, axis=1)[:, min(k, d.shape[1]) - 1]
            # The short cut above rounds; what it leaves in doubt is measured exactly.
            at, other = np.nonzero(d <= (kth + 1e-9 * (1 + np.abs(kth) + square.max()))[:, None])
            exact = np.sqrt(((own[at] - held[other]) ** 2).sum(axis=1))
            order = np.lexsort((theirs[other], exact, at))
            at, other, exact = at[order], other[order], exact[order]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            keep = place < k
            out_q.append(asking[i + at[keep]])
            out_c.append(theirs[other[keep]])
            out_d.append(exact[keep])
        join = lambda a, kind: pa.array(np.concatenate(a) if a else [], kind)
        return pa.table([join(out_q, pa.int64()), join(out_c, pa.int64()), join(out_d, pa.float64())], ["least", "near", "score"])

    return run


def usable(vector) -> Column:
    v = F.col(vector)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & good & F.exists(v, lambda x: x != 0)


def nearest(table: DataFrame, asks: Column, k: int = 10, id: str = "vec_id", vector: str = "embedding", curves: int = CURVES, target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for every row where ``asks`` holds.

    Score is the Euclidean distance in double precision; ties go to the smaller id, null ids last. Rows
    with the id of the query are its own and no candidates. Vectors that are null, empty, zero, or hold null or
    non-finite numbers take no part, nor do vectors whose length is not the most frequent one. With
    fewer candidates all are returned. An empty table gives an empty table.
    """
    spark = table.sparkSession
    ship(spark)
    # Adding zero makes one zero of two.
    kind = "float" if isinstance(table.schema[vector].dataType.elementType, T.FloatType) else "double"
    plain = F.transform(vector, lambda x: x.cast(kind) + F.lit(0).cast(kind))
    rows = table.select(id_of(id).alias("_id"), F.coalesce(asks, F.lit(False)).alias("asks"), plain.alias("v")).where(usable("v"))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("v") == F.lit(size.n if size else 0))
    rows = freeze(rows.withColumn("class", F.concat_ws(" ", F.xxhash64("v"), F.xxhash64(F.reverse("v"), F.lit(1)))), "vectors")
    # One point for equal vectors: the k + 1 smallest ids, and whether one of them asks.
    classes = rows.groupBy("class").agg(F.min("_id").alias("least"), F.count("*").alias("n"), F.max("asks").alias("asks"), F.first("v").alias("v"))
    classes = freeze(classes, "classes")
    smallest = rows.select("class", "_id").distinct().withColumn("r", F.row_number().over(Window.partitionBy("class").orderBy("_id"))).where(F.col("r") <= k + 1)
    members = smallest.groupBy("class").agg(F.sort_array(F.collect_list("_id")).alias("ids"))
    members = freeze(classes.select("class", "least").join(members, "class").select("least", "ids"), "members")
    totals = classes.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("asks").cast("int")), F.lit(0)).alias("asked")).first()
    if not totals.n:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    sample = classes.select("v").where(F.pmod(F.xxhash64("class", F.lit(3)), F.lit(1 << 20)) < int((1 << 20) * min(1.0, SAMPLE_ROWS / totals.n))).limit(2 * SAMPLE_ROWS).toArrow()
    sample = _matrix(sample.column("v")) if len(sample) else _matrix(classes.select("v").limit(1).toArrow().column("v"))
    index = build_index(sample[np.lexsort(sample.T[::-1])], k, curves, target)
    sent = spark.sparkContext.broadcast(index)
    blocks = max(1, int(2 / index.share)) if index.share < 1 else 1
    salts = max(1, -(-totals.n // (blocks * UNIT_ROWS)))
    queries = max(1, -(-int(totals.asked * min(1.0, 2 * index.share + 1 / blocks)) // UNIT_QUERIES))
    place = _places(sent, blocks, queries, salts)
    salt = F.pmod(F.xxhash64("class", F.lit(9)), F.lit(1 << 30))
    placed = classes.select("least", "v", F.explode(place("v", "asks", salt)).alias("at")).select("least", "v", "at.*")
    # A row meets the queries of all its blocks; a query meets all rows of the blocks of its window.
    found = placed.groupBy("unit", "part").applyInArrow(_nearest(k + 1), "least long, near long, score double")
    merged = found.dropDuplicates(["least", "near"])
    merged = merged.withColumn("r", F.row_number().over(Window.partitionBy("least").orderBy("score", "near"))).where(F.col("r") <= k + 1)

    # Classes back to rows: the members of the nearest classes, then each asking row without itself.
    near = merged.join(members.withColumnRenamed("least", "near"), "near").select("least", F.explode("ids").alias("id"), "score")
    lists = near.withColumn("r", F.row_number().over(Window.partitionBy("least").orderBy("score", "id"))).where(F.col("r") <= k + 1)
    lists = lists.groupBy("least").agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("found"))
    asking = join_classes(rows.where("asks").select("class", "_id"), classes.where("asks").select("class", "least", "n"), "class", "n", "_id")
    lists = lists.join(classes.where("asks").select("least", "n"), "least")
    told = join_classes(asking.select("least", "_id"), freeze(lists, "found"), "least", "n", "_id")
    told = told.withColumn("found", F.slice(F.filter("found", lambda x: x["id"] != F.col("_id")), 1, k))
    out = told.select("_id", F.posexplode("found").alias("at", "hit")).withColumn("hit_id", F.col("hit.id"))
    return out.select(id_back("_id").alias("query_id"), (F.col("at") + 1).alias("rank"), id_back("hit_id").alias("vec_id"), F.col("hit.score").alias("score"))
