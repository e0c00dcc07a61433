"""Vector codes: codebooks by parts, trained exactly under adaptive distance bounds.

A vector is cut into equal parts, and each part is replaced by the number of the nearest entry of its
position's codebook. While the codebooks are trained, each part keeps its entry, an upper bound of the
distance to it, the ``b`` next entries in the order of their lower bounds, and one outer bound of all
other entries. When entries move, the upper bound grows by the own entry's drift, each lower bound
shrinks by its entry's, the outer one by the largest. As long as the upper bound is below all of them
nothing is measured; if only some of the b are in reach those are measured; only if the outer bound is
reached are all. ``b`` follows how many were needed in the round before.

Bounds are integers, upper ones rounded up and lower ones down, and what they leave in doubt is
decided by integer squared distances. A round reads the vectors with their bounds once and writes them
back; each task adds a row a codebook entry with its sums, which are all that shuffles.
"""

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.lattice import Rounds, finite, floor_means, floored, lists, matrix, root_down, root_up, squared_distances
from sensorloom.session import freeze

#: Beyond any bound.
FAR = 1 << 40
NONE = -1
#: b covers this share of the parts; if more than the rest reach the outer bound, it grows.
COVERED = 0.99
#: A label with more than 1/HOT of all rows is hot, so at most HOT labels are.
HOT = 1024


@dataclass
class Bounds:
    """Of one part position, a row a vector: entry, upper bound, next entries with lower bounds, outer bound."""

    at: np.ndarray
    above: np.ndarray
    near: np.ndarray
    low: np.ndarray
    outer: np.ndarray


def scan(x: np.ndarray, book: np.ndarray, b: int) -> tuple[Bounds, np.ndarray]:
    """Bounds and exact distances from all entries."""
    d = squared_distances(x, book)
    order = np.argsort(d, axis=1, kind="stable")  # the lower index of equals first
    sorted_d = np.take_along_axis(d, order, axis=1)
    roots = root_down(sorted_d)
    k = len(book)
    near, low = np.full((len(x), b), NONE, np.int64), np.full((len(x), b), FAR, np.int64)
    kept = min(b, k - 1)
    near[:, :kept], low[:, :kept] = order[:, 1 : kept + 1], roots[:, 1 : kept + 1]
    outer = roots[:, kept + 1] if k > kept + 1 else np.full(len(x), FAR, np.int64)
    return Bounds(order[:, 0], root_up(sorted_d[:, 0]), near, low, outer), sorted_d[:, 0]


def fitted(s: Bounds, b: int) -> Bounds:
    """The same bounds with room for ``b`` entries: what is dropped goes under the outer bound."""
    have = s.near.shape[1]
    order = np.argsort(s.low, axis=1, kind="stable")
    near, low = np.take_along_axis(s.near, order, axis=1), np.take_along_axis(s.low, order, axis=1)
    if b < have:
        outer = np.minimum(s.outer, low[:, b])  # the smallest of the dropped ones
        return Bounds(s.at, s.above, near[:, :b], low[:, :b], outer)
    pad = ((0, 0), (0, b - have))
    return Bounds(s.at, s.above, np.pad(near, pad, constant_values=NONE), np.pad(low, pad, constant_values=FAR), s.outer)


def advance(x: np.ndarray, s: Bounds, book: np.ndarray, moved: np.ndarray, b: int) -> tuple[Bounds, np.ndarray]:
    """Bounds after the entries moved (by at most ``moved``), and how many next entries each part needed.

    A part that had to be measured against all entries counts as one more than it keeps.
    """
    have = s.near.shape[1]
    above = s.above + moved[s.at]
    low = np.where(s.near == NONE, FAR, s.low - moved[s.near])
    outer = np.where(s.outer >= FAR, FAR, s.outer - moved.max())
    at, near = s.at.copy(), s.near.copy()
    needed = np.zeros(len(x), np.int64)
    reached = lambda rows: np.minimum(low[rows].min(1, initial=FAR), outer[rows]) <= above[rows]
    doubt = np.flatnonzero(reached(np.arange(len(x))))
    own = ((x[doubt] - book[at[doubt]]) ** 2).sum(1)
    above[doubt] = root_up(own)
    still = reached(doubt)
    doubt, own = doubt[still], own[still]
    whole = outer[doubt] <= above[doubt]
    some, own = doubt[~whole], own[~whole]
    if len(some):
        entries = np.concatenate([at[some][:, None], near[some]], axis=1)
        asked = np.concatenate([np.ones((len(some), 1), bool), low[some] <= above[some][:, None]], axis=1)
        needed[some] = asked[:, 1:].sum(1)
        d = np.full(entries.shape, np.iinfo(np.int64).max)
        d[:, 0] = own
        r, c = np.nonzero(asked[:, 1:])
        d[r, c + 1] = ((x[some[r]] - book[entries[r, c + 1]]) ** 2).sum(1)
        best = np.lexsort((entries, d), axis=1)[:, 0] if entries.shape[1] > 1 else np.zeros(len(some), np.int64)
        rows = np.arange(len(some))
        at[some], above[some] = entries[rows, best], root_up(d[rows, best])
        # The winner changes places with the first column; the measured ones now have exact bounds.
        bounds = np.concatenate([np.zeros((len(some), 1), np.int64), low[some]], axis=1)
        bounds[asked] = root_down(d[asked])
        entries[rows, best], bounds[rows, best] = entries[:, 0], bounds[:, 0]
        near[some], low[some] = entries[:, 1:], bounds[:, 1:]
    out = fitted(Bounds(at, above, near, low, outer), b)
    full = doubt[whole]
    if len(full):
        needed[full] = have + 1
        new, _ = scan(x[full], book, b)
        for field in ("at", "above", "near", "low", "outer"):
            getattr(out, field)[full] = getattr(new, field)
    return out, needed


def adapted(b: int, needed: dict[int, int], k: int) -> int:
    """The next b: what ``COVERED`` of the parts needed, at least k/8; one more than that reach the outer bound let it grow."""
    total = sum(needed.values())
    if needed.get(b + 1, 0) > (1 - COVERED) * total:
        return min(2 * b, max(1, k - 2))
    so_far, least = 0, max(1, k // 8)
    for depth in range(b + 1):
        so_far += needed.get(depth, 0)
        if so_far >= COVERED * total:
            return min(b, max(least, depth))
    return b


@dataclass
class Step:
    books: np.ndarray  # part, entry, component
    b: int
    moved: np.ndarray | None = None  # part, entry; none before the first round
    last: bool = False


NAMES = ["id", "label", "v", "at", "above", "near", "low", "outer", "code", "error", "slot", "n", "sums"]
STATE = "v array<int>, at array<int>, above array<bigint>, near array<int>, low array<bigint>, outer array<bigint>, code string, error bigint"
SUMMARY = "slot int, n bigint, sums array<bigint>"


def _round(sent, parts: int, part_width: int, have: int):
    """One round over the vectors; slots from 0 are codebook entries, -1 - d counts the parts that needed d next entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step: Step = sent.value
        k, width = step.books.shape[1], parts * part_width
        n, sums, needed = np.zeros(parts * k, np.int64), np.zeros((parts * k, part_width), np.int64), np.zeros(k + 2, np.int64)
        schema = None
        for rows in batches:
            if not rows.num_rows:
                continue
            x, done, error = matrix(rows.column("v"), width), [], np.zeros(rows.num_rows, np.int64)
            if step.moved is not None:
                at, above, outer = (matrix(rows.column(c), parts) for c in ("at", "above", "outer"))
                near, low = (matrix(rows.column(c), parts * have) for c in ("near", "low"))
            for p in range(parts):
                own, book = np.ascontiguousarray(x[:, p * part_width : (p + 1) * part_width]), step.books[p]
                if step.moved is None:
                    s, d = scan(own, book, step.b)
                    needed[min(step.b, k - 1) + 1] += len(own)
                else:
                    cut = slice(p * have, (p + 1) * have)
                    s, depth = advance(own, Bounds(at[:, p], above[:, p], near[:, cut], low[:, cut], outer[:, p]), book, step.moved[p], step.b)
                    needed += np.bincount(depth, minlength=k + 2)
                if step.last:
                    error += ((own - book[s.at]) ** 2).sum(1)
                order = np.argsort(s.at, kind="stable")
                begins = np.flatnonzero(np.r_[True, np.diff(s.at[order]) > 0])
                slot = p * k + s.at[order][begins]
                sums[slot] += np.add.reduceat(own[order], begins)
                n[p * k : (p + 1) * k] += np.bincount(s.at, minlength=k)
                done.append(s)
            entries = np.stack([s.at for s in done], 1)
            code = pa.array([bytes(r).hex() for r in entries.astype(np.uint8)]) if step.last else pa.nulls(len(x), pa.string())
            columns = [rows.column("id"), rows.column("label"), rows.column("v"), lists(entries, pa.int32()), lists(np.stack([s.above for s in done], 1), pa.int64())]
            columns += [lists(np.concatenate([s.near for s in done], 1), pa.int32()), lists(np.concatenate([s.low for s in done], 1), pa.int64())]
            columns += [lists(np.stack([s.outer for s in done], 1), pa.int64()), code, pa.array(error)]
            none = [pa.nulls(len(x), t) for t in (pa.int32(), pa.int64(), pa.list_(pa.int64()))]
            out = pa.RecordBatch.from_arrays([*columns, *none], NAMES)
            schema = out.schema
            yield out
        held, depths = np.flatnonzero(n), np.flatnonzero(needed)
        if len(held):
            slots = np.r_[held, -1 - depths]
            counts = np.r_[n[held], needed[depths]]
            told = np.concatenate([sums[held], np.zeros((len(depths), part_width), np.int64)])
            columns = [pa.nulls(len(slots), schema.field(i).type) for i in range(10)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(slots, pa.int32()), pa.array(counts), lists(told, pa.int64())], NAMES)

    return run


@dataclass
class Codes:
    rows: DataFrame
    books: np.ndarray
    #: Of each round: the b in use, and how many parts needed how many next entries (b + 1: measured against all).
    needed: list[tuple[int, dict[int, int]]]


def compress(
    table: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, id: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> Codes:
    """Codes of floor(``scale`` * x): (id, code, error, label_error, codebooks_sha256) for each usable vector.

    A code has two hex digits a part, so there are at most 256 entries; ties go to the lower index. Vectors that are null or
    hold null or non-finite components take no part, and neither do those whose length is not the most
    frequent one that ``parts`` divides (equal counts: the shorter), since a codebook has one length; empty ones have none.
    The codebooks start from the smallest ids; a null id is larger than any, equal ids go by their vectors. With fewer vectors there are
    fewer entries, with none an empty result. Null labels are one label. Repeated rows each give a row; other columns
    do not matter, whatever their names. Components beyond 2^27 after scaling fail the job.
    """
    spark = table.sparkSession
    kept = table.where(finite(vector)).select(F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v"))
    lengths = kept.groupBy(F.size("v").alias("n")).count().where((F.col("n") > 0) & (F.col("n") % parts == 0))
    most = lengths.orderBy(F.desc("count"), "n").first()
    width = most.n if most else parts
    held = Rounds("parts")
    kept = held.write(kept.where(F.size("v") == width).select("id", "label", floored("v", scale).alias("v")))
    first = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    types = [f"{c} {kept.schema[c].dataType.simpleString()}" for c in ("id", "label")]
    schema = ", ".join([*types, STATE, SUMMARY])
    if not first:
        return Codes(_result(spark.createDataFrame([], schema), np.zeros((parts, 0, 0), np.int64), id), np.zeros((parts, 0, width // parts)), [])
    books = np.array([r.v for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    k, w = books.shape[1:]
    step, state, told, have = Step(books, max(1, k // 4), last=rounds == 0), kept, [], 0
    for i in range(rounds + 1):
        sent = spark.sparkContext.broadcast(step)
        state = held.write(state.mapInArrow(_round(sent, parts, w, have), schema))
        have = step.b
        summary = state.where("slot is not null").groupBy("slot")
        found = summary.agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(w)]).alias("sums")).collect()
        state = state.where("slot is null")
        n, sums = np.zeros(parts * k, np.int64), np.zeros((parts * k, w), np.int64)
        needed = {-1 - r.slot: r.n for r in found if r.slot < 0}
        for r in found:
            if r.slot >= 0:
                n[r.slot], sums[r.slot] = r.n, r.sums
        told.append((step.b, needed))
        if i < rounds:
            after = floor_means(sums.reshape(parts, k, w), n.reshape(parts, k), step.books)
            moved = root_up(((after - step.books) ** 2).sum(2))
            # The first round measures all, so it says nothing of what is needed.
            step = Step(after, step.b if i == 0 else adapted(step.b, needed, k), moved, i + 1 == rounds)
    return Codes(_result(state, step.books, id), step.books, told)


def _result(state: DataFrame, books: np.ndarray, id: str) -> DataFrame:
    """Rows with the error summed over equal labels; the few hot labels are sent, so no label meets in one task."""
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1))).encode()).hexdigest()
    rows = state.select("id", "label", "code", "error")
    sums = freeze(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "labels")
    total = sums.agg(F.sum("n")).first()[0] or 0
    hot = F.broadcast(sums.where(F.col("n") > total / HOT).select(F.col("label").alias("_l"), "label_error"))
    cold = sums.where(F.col("n") <= total / HOT).select(F.col("label").alias("_l"), "label_error")
    same = F.col("label").eqNullSafe(F.col("_l"))
    out = rows.join(hot, same).unionByName(rows.join(hot.select("_l"), same, "left_anti").join(cold, same))
    return out.select(F.col("id").alias(id), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
