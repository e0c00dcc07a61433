"""Near duplicates: SimHash fingerprints linked through vantage-point trees.

A tree is built on the driver from a bounded sample of fingerprints: each node holds a vantage
point and a distance, and its two branches are the fingerprints nearer and farther than that. Its
leaves are the shards. A fingerprint has one home shard; it also visits every shard that its ball
of ``RADIUS`` bits reaches over a boundary, and the triangle bound rules out all others. Two linked
fingerprints part ways at one node at most: it is enough that the nearer one crosses there.
In a shard the same idea continues on a local tree, down to blocks that are compared bit by bit.

Equal fingerprints are one class from the start. A shard gives the links it finds as a spanning
forest, so a group of m near copies costs at most m - 1 links for a batch, never m * m.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import id_back, id_of, join_classes, release, text_of
from sensorloom.llm.components import connected_components
from sensorloom.session import freeze, ship

RADIUS = 4
SHINGLE = 4
SEED = 42
#: Fingerprints at home in a shard, about.
SHARD_ROWS = 1 << 15
#: Fingerprints that the tree is built from, at most. The tree decides costs, not results.
SAMPLE_ROWS = 1 << 16
#: Compared bit by bit when a local branch has so few points.
BLOCK_ROWS = 256
#: Queries that a block meets at a time, and pairs found that are held before they are thinned out.
BLOCK_QUERIES = 1024
PAIRS = 1 << 18


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: bytes) -> int:
    """64 bits: set where over half of the hashes of all 4-word shingles have the bit set."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < SHINGLE:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        after = np.cumsum([len(w) + 1 for w in words])
        begin = [0, *after[: len(words) - SHINGLE].tolist()]
        end = (after[SHINGLE - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[i:j], SEED) for i, j in zip(begin, end)]
    bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The text comes last; its fingerprint takes its place."""
    for b in batches:
        got = np.array([fingerprint(t.as_buffer().to_pybytes()) for t in b.column(b.num_columns - 1)], np.uint64)
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got.view(np.int64), pa.int64())], [*b.schema.names[:-1], "fp"])
    release()


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(_id, fp) of every row; fp is the fingerprint as a signed long."""
    ship(docs.sparkSession)
    return docs.select(id_of(id).alias("_id"), text_of(text).alias("t")).mapInArrow(_fingerprints, "_id long, fp long")


# ---------------------------------------------------------------- the tree


def distance(fps: np.ndarray, point) -> np.ndarray:
    return np.bitwise_count(fps ^ np.uint64(point)).astype(np.int16)


def _cut(points: np.ndarray, rng: np.random.Generator, radius: int) -> tuple[int, int] | None:
    """The vantage point and distance that let the fewest fingerprints cross, of some candidates."""
    best = None
    for point in rng.choice(points, 8):
        d = np.sort(distance(points, point))
        for q in (0.3, 0.4, 0.5, 0.6, 0.7):
            at = int(d[int(q * (len(d) - 1))])
            near = np.searchsorted(d, at, "right")
            if min(near, len(d) - near) < len(d) // 5:
                continue
            cross = np.searchsorted(d, at + radius, "right") - np.searchsorted(d, at - radius, "right")
            if best is None or cross < best[0]:
                best = (cross, int(point), at)
    return best and best[1:]


def build_tree(sample: np.ndarray, depth: int, radius: int = RADIUS) -> tuple:
    """Nested (point, distance, nearer branch, farther branch); a leaf is its number."""
    rng, leaves = np.random.default_rng(0), iter(range(1 << 62))

    def grow(points, left):
        cut = _cut(points, rng, radius) if left and len(points) >= 16 else None
        if cut is None:
            return next(leaves)
        near = distance(points, cut[0]) <= cut[1]
        return (*cut, grow(points[near], left - 1), grow(points[~near], left - 1))

    return grow(sample, depth)


def route(tree, fps: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(shard, places in ``fps``, whether they are at home there) for all that must be there."""

    def go(node, at, home):
        if not len(at):
            return
        if isinstance(node, int):
            yield node, at, home
            return
        point, cut, nearer, farther = node
        d = distance(fps[at], point)
        if home:
            yield from go(nearer, at[d <= cut], True)
            yield from go(farther, at[d > cut], True)
            yield from go(farther, at[(d <= cut) & (d + radius > cut)], False)
        else:
            yield from go(nearer, at[d - radius <= cut], False)
            yield from go(farther, at[d + radius > cut], False)

    yield from go(tree, np.arange(len(fps)), True)


def near_pairs(points: np.ndarray, queries: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in points, in queries) of all pairs within ``radius`` bits, by a local tree."""
    rng = np.random.default_rng(1)

    def blocks(p, q):
        for i in range(0, len(p), BLOCK_ROWS):
            own = p[i : i + BLOCK_ROWS]
            for j in range(0, len(q), BLOCK_QUERIES):
                other = q[j : j + BLOCK_QUERIES]
                x, y = np.nonzero(np.bitwise_count(points[own][:, None] ^ queries[other][None, :]) <= radius)
                if len(x):
                    yield own[x], other[y]

    def go(p, q):
        if not len(p) or not len(q):
            return
        cut = None
        if len(p) > BLOCK_ROWS and len(q) > 16:
            cut = _cut(points[rng.choice(p, 256)], rng, radius)
        if cut is None:
            yield from blocks(p, q)
            return
        near, d = distance(points[p], cut[0]) <= cut[1], distance(queries[q], cut[0])
        yield from go(p[near], q[d - radius <= cut[1]])
        yield from go(p[~near], q[d + radius > cut[1]])

    yield from go(np.arange(len(points)), np.arange(len(queries)))


# ---------------------------------------------------------------- links


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as join the same nodes: each node with the smallest of its component."""
    nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = places[: len(a)], places[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low, high = np.minimum(label[u], label[v]), np.maximum(label[u], label[v])
        if (low == high).all():
            break
        np.minimum.at(label, high, low)
        while (label != label[label]).any():
            label = label[label]
    child = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[child], nodes[label[child]]


def _routed(tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for shard, at, home in route(tree, fps):
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, shard), pa.int32()), pa.array(np.full(n, not home)), pa.array(fps[at].view(np.int64))], ["shard", "visits", "fp"]
                )

    return run


def _shard_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by shard, those at home first; visitors stream past them batch by batch."""

    def out(pairs):
        a, b = spanning_links(np.concatenate([x for x, _ in pairs]), np.concatenate([y for _, y in pairs]))
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    def linked(points, queries, same):
        waiting, n = [], 0
        for x, y in near_pairs(points, queries):
            if same:
                x, y = x[x < y], y[x < y]
            waiting.append((points[x], queries[y]))
            n += len(x)
            if n >= PAIRS:
                yield out(waiting)
                waiting, n = [], 0
        if n:
            yield out(waiting)

    shard, home, points = None, [], None
    for b in batches:
        of = b.column("shard").to_numpy(zero_copy_only=False)
        visits = b.column("visits").to_numpy(zero_copy_only=False)
        fps = b.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        for s in np.unique(of):
            mine = of == s
            if s != shard:
                if home:
                    points = np.concatenate(home)
                    yield from linked(points, points, True)
                shard, home, points = s, [], None
            if (mine & ~visits).any():
                home.append(fps[mine & ~visits])
            guests = fps[mine & visits]
            if len(guests):
                if points is None:
                    points = np.concatenate(home) if home else np.zeros(0, np.uint64)
                    home = []
                    yield from linked(points, points, True)
                yield from linked(points, guests, False)
    if home:
        points = np.concatenate(home)
        yield from linked(points, points, True)
    release()


def links(classes: DataFrame, n: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b) pairs of fingerprints that join all within ``RADIUS`` bits; ``classes(fp)`` is distinct."""
    spark = classes.sparkSession
    depth = max(0, int(np.ceil(np.log2(max(1, n) / shard_rows))))
    sample = classes.select("fp").sample(min(1.0, SAMPLE_ROWS / max(1, n)), seed=0).limit(2 * SAMPLE_ROWS) if depth else None
    points = np.array([r.fp for r in sample.collect()], np.int64).view(np.uint64) if depth else np.zeros(0, np.uint64)
    tree = build_tree(points, depth)
    placed = classes.select("fp").mapInArrow(_routed(tree), "shard int, visits boolean, fp long")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << depth)
    return placed.repartition(parts, "shard").sortWithinPartitions("shard", "visits").mapInArrow(_shard_links, "a long, b long")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(id, fp, component_id) of every row: its fingerprint and the smallest id linked to it over any steps.

    A null or blank text has fingerprint zero and is linked like any other. Equal ids are rows of
    their own; a null id is larger than any other, and gives a null component only among null ids.
    An empty table gives an empty table.
    """
    rows = freeze(fingerprints(docs, id, text), "fingerprints")
    of_class = _classes(rows, "_id", shard_rows)
    return join_classes(rows, of_class, "fp", "n", "_id").select(id_back("_id").alias(id), "fp", id_back("component").alias("component_id"))


def _classes(rows: DataFrame, least: str, shard_rows: int) -> DataFrame:
    """(fp, n, component) of every fingerprint in ``rows``: its rows and the smallest ``least`` linked to it."""
    classes = freeze(rows.groupBy("fp").agg(F.min(least).alias("least"), F.count("*").alias("n")), "classes")
    roots = connected_components(links(classes, classes.count(), shard_rows))
    linked = freeze(classes.join(roots.withColumnRenamed("node", "fp"), "fp"), "linked")
    least = freeze(linked.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("fps")), "components")
    found = join_classes(linked.select("fp", "root"), least, "root", "fps", "fp").select("fp", "component")
    return freeze(classes.join(found, "fp", "left").select("fp", "n", F.coalesce("component", "least").alias("component")), "of_class")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, whatever the ids.

    That is the row with the smallest id (a null id is larger than any other), of equal ids the one with the
    smallest fingerprint, then the smallest hash of the text; of rows equal in all that, any one.
    """
    ship(docs.sparkSession)
    # The number of a row is that of the written table, so it stays what it is.
    numbered = freeze(docs.select(F.struct(*docs.columns).alias("_doc"), F.monotonically_increasing_id().alias("_row")), "numbered")
    own = numbered.select("_row", F.col("_doc").getField(id).alias("id"), F.col("_doc").getField(text).alias("text"))
    given = own.select("_row", id_of("id").alias("_id"), F.xxhash64(text_of("text")).alias("_hash"), text_of("text").alias("t"))
    rows = freeze(given.mapInArrow(_fingerprints, "_row long, _id long, _hash long, fp long"), "fingerprints")
    rows = rows.select("_row", "fp", F.struct("_id", "fp", "_hash", "_row").alias("_order"))
    found = join_classes(rows.select("fp", "_row"), _classes(rows, "_order", shard_rows), "fp", "n", "_row")
    gone = freeze(found.where(F.col("_row") != F.col("component._row")).select("_row"), "gone")
    return numbered.join(gone, "_row", "left_anti").select("_doc.*")


def hex_of(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
