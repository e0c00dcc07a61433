"""Exact k-means by bounds whose drift is tightened geometrically.

Every vector keeps the number of its centre, an upper bound of the distance to it, and a lower bound of
the distance to all others. When centres move, the upper bound grows by the own centre's drift. The
lower bound would have to shrink by the largest drift of the others; it shrinks by less: the members of
a cluster lie in a sphere, and how much nearer a moved centre can have come to any point of that sphere
is bounded in the plane of the sphere's middle and the two places of the centre (``loosening``). Only
vectors whose bounds cross are measured, first against their own centre, then against all.

A pass reads the vectors with their bounds once and writes them back with the new ones; each task adds
one row a cluster with its counts, sums and radius. Nothing shuffles but those rows, so neither a
cluster nor a vector that a third of the rows hold meets in one task. The centres (k rows) are all
that is collected and sent.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.lattice import Rounds, finite, floor_means, floored, lists, matrix, own_distances, squared_distances

#: Bounds are doubles: an upper bound must be below by this share, and by this much, to count as below.
SLACK, LEAST = 1e-9, 1e-9


def loosening(middle: np.ndarray, radius: float, before: np.ndarray, after: np.ndarray) -> float:
    """How much nearer a centre can have come, by moving, to a point of a sphere; at most its drift.

    With m between both places, D the drift and z the coordinate of x along the move from m,
    |x - before| - |x - after| = 2 D z / (|x - before| + |x - after|). The sum below is at least 2|x - m|
    and at most 2 sqrt(|x - m|^2 + D^2/4), so for z > 0 the value is at most D cos(angle of x seen from m),
    and for z < 0 at most D cos(angle) |x - m| / sqrt(|x - m|^2 + D^2/4). Seen from m, the sphere reaches an
    angle of asin(radius / distance) to each side of its middle, and no nearer than distance - radius.
    """
    move = after - before
    drift = float(np.sqrt((move * move).sum()))
    if drift == 0:
        return 0.0
    seen = middle - (before + after) / 2
    far = float(np.sqrt((seen * seen).sum()))
    if far <= radius:
        return drift
    angle = np.arccos(np.clip(seen @ move / (far * drift), -1, 1)) - np.arcsin(radius / far)
    if angle < np.pi / 2:
        return drift * float(np.cos(max(angle, 0.0)))
    near = far - radius
    return drift * float(np.cos(angle)) * near / float(np.sqrt(near * near + drift * drift / 4))


@dataclass
class Step:
    """What the tasks of a pass need: the centres, and how they moved since the last pass (none before the first)."""

    centres: np.ndarray
    drift: np.ndarray | None = None  # of each centre
    loosen: np.ndarray | None = None  # of the lower bounds of each cluster's members
    half: np.ndarray | None = None  # half the distance to the nearest other centre
    last: bool = False


def next_step(before: np.ndarray, after: np.ndarray, radius: np.ndarray, last: bool) -> Step:
    old, new, k = before.astype(float), after.astype(float), len(after)
    drift = np.sqrt(((new - old) ** 2).sum(1))
    loosen = [max((loosening(old[a], radius[a], old[j], new[j]) for j in range(k) if j != a), default=0.0) for a in range(k)]
    between = np.sqrt(squared_distances(after, after).astype(float))
    np.fill_diagonal(between, np.inf)
    return Step(after, drift * (1 + SLACK), np.array(loosen) + LEAST, between.min(1) / 2, last)


STATE = "v array<int>, cluster int, above double, below double, distance bigint"
SUMMARY = "slot int, n bigint, scanned bigint, radius double, total bigint, sums array<bigint>"


def _nearest_two(d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at = d.argmin(1)  # the first of equals
    rows = np.arange(len(d))
    least = d[rows, at]
    if d.shape[1] == 1:
        return at, least, np.full(len(d), np.inf)
    rest = d.astype(float)
    rest[rows, at] = np.inf
    return at, least, np.sqrt(rest.min(1))


def _pass(sent, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step: Step = sent.value
        k = len(step.centres)
        n, scanned, total = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros(k, np.int64)
        radius, sums = np.zeros(k), np.zeros((k, width), np.int64)
        schema = None
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column("v"), width)
            if step.drift is None:
                at, d, below = _nearest_two(squared_distances(x, step.centres))
                above = np.sqrt(d.astype(float))
                scan = np.ones(len(x), bool)
            else:
                at = b.column("cluster").to_numpy().astype(np.int64)
                above = b.column("above").to_numpy() + step.drift[at]
                below = b.column("below").to_numpy() - step.loosen[at]
                d = np.zeros(len(x), np.int64)
                crossed = lambda: above * (1 + SLACK) + LEAST >= np.maximum(below * (1 - SLACK), step.half[at])
                measured = crossed() | step.last
                d[measured] = own_distances(x[measured], step.centres, at[measured])
                above[measured] = np.sqrt(d[measured].astype(float))
                scan = measured & crossed()
                if scan.any():
                    at[scan], d[scan], below[scan] = _nearest_two(squared_distances(x[scan], step.centres))
                    above[scan] = np.sqrt(d[scan].astype(float))
            n += np.bincount(at, minlength=k)
            scanned += np.bincount(at[scan], minlength=k)
            np.add.at(total, at, d)
            np.maximum.at(radius, at, above)
            order = np.argsort(at, kind="stable")
            begins = np.flatnonzero(np.r_[True, np.diff(at[order]) > 0])
            sums[at[order][begins]] += np.add.reduceat(x[order], begins)
            columns = [b.column("id"), b.column("v"), pa.array(at, pa.int32()), pa.array(above), pa.array(below), pa.array(d)]
            none = [pa.nulls(len(x), t) for t in (pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.int64()))]
            out = pa.RecordBatch.from_arrays([*columns, *none], NAMES)
            schema = out.schema
            yield out
        held = np.flatnonzero(n)
        if len(held):
            columns = [pa.nulls(len(held), schema.field(i).type) for i in range(6)]
            own = [pa.array(held, pa.int32()), *(pa.array(a[held]) for a in (n, scanned, radius, total)), lists(sums[held], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *own], NAMES)

    return run


NAMES = ["id", "v", "cluster", "above", "below", "distance", "slot", "n", "scanned", "radius", "total", "sums"]


@dataclass
class Clustering:
    rows: DataFrame
    centres: np.ndarray
    inertia: int
    #: Of each pass: vectors that were measured against all centres.
    scanned: list[int]


def cluster(
    table: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, width: int = 64, id: str = "vec_id", vector: str = "embedding", seed: str = "1"
) -> Clustering:
    """Lloyd's clustering of floor(``scale`` * x): exact assignments, ties to the smaller number.

    The rows are (id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one for each vector of exactly
    ``width`` components, none of them null or non-finite; other vectors, nulls and empty ones among them, take no
    part. Other columns of the table do not matter, whatever their names. Centres start as the ``k`` vectors with the
    smallest sha256 of ``seed:id``; a null id hashes as larger than any, equal ids (repeated rows) go by their vectors. With
    fewer than ``k`` vectors there are as many centres, with none an empty result. Repeated rows each give a row.
    Components beyond 2^27 after scaling fail the job, since distances would not fit a long.
    """
    spark = table.sparkSession
    kept = table.where(finite(vector) & (F.size(vector) == width)).select(F.col(id).alias("id"), floored(vector, scale).alias("v"))
    held = Rounds("vectors")
    kept = held.write(kept)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    first = kept.orderBy(key.asc_nulls_last(), "v").limit(k).select("v").collect()
    schema = f"id {kept.schema['id'].dataType.simpleString()}, {STATE}, {SUMMARY}"
    if not first:
        return Clustering(_result(spark.createDataFrame([], schema), np.zeros((0, width), np.int64), np.zeros(0, np.int64), id), np.zeros((0, width)), 0, [])
    step, scanned, state = Step(np.array([r.v for r in first], np.int64), last=rounds == 0), [], kept
    k = len(step.centres)
    for i in range(rounds + 1):
        sent = spark.sparkContext.broadcast(step)
        state = held.write(state.mapInArrow(_pass(sent, width), schema))
        summary = state.where("slot is not null").groupBy("slot")
        parts = summary.agg(
            *[F.sum(c).alias(c) for c in ("n", "scanned", "total")], F.max("radius").alias("radius"), F.array(*[F.sum(F.col("sums")[j]) for j in range(width)]).alias("sums")
        ).collect()
        state = state.where("slot is null")
        n, total, radius, sums = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros(k), np.zeros((k, width), np.int64)
        for r in parts:
            n[r.slot], total[r.slot], radius[r.slot], sums[r.slot] = r.n, r.total, r.radius, r.sums
        scanned.append(sum(r.scanned for r in parts))
        if i < rounds:
            step = next_step(step.centres, floor_means(sums, n, step.centres), radius * (1 + SLACK), i + 1 == rounds)
    return Clustering(_result(state, step.centres, total, id), step.centres, int(total.sum()), scanned)


def _result(state: DataFrame, centres: np.ndarray, total: np.ndarray, id: str) -> DataFrame:
    """Rows of the last pass with what holds for their cluster: a table of k rows, sent to all tasks."""
    told = [(a, int(total[a]), int(total.sum()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for a, c in enumerate(centres)]
    spark: SparkSession = state.sparkSession
    clusters = spark.createDataFrame(told, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    joined = state.select("id", "cluster", "distance").join(F.broadcast(clusters), "cluster")
    return joined.select(F.col("id").alias(id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
