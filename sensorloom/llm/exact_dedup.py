"""Exact duplicates by two passes of a Bloom filter.

Pass 1 hashes every text and counts, in cells of a filter, how many rows hit a cell: none, one,
or more. A text that occurs twice hits all its cells twice. Pass 2 probes every row: a row with
a cell that only it has hit is certainly alone and passes straight through, without a shuffle.
The rest (the repeated texts and about 1.4 % false alarms) shuffles by SHA-256.

The filter is cut into segments of a fixed size by a second hash, so that building it never needs
one task for the whole. Up to ``FILTER_BYTES`` of filter are sent to all tasks; a larger filter
stays distributed, and the 8-byte hashes travel to their segment instead of the filter.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import id_back, id_of, join_classes, release, text_of
from sensorloom.session import freeze, ship

CELLS_PER_ROW = 16
HASHES = 2
SEGMENT_CELLS = 1 << 22
#: Largest filter that is sent to every task: 33 million rows at one bit a cell.
FILTER_BYTES = 64 << 20
CHUNK_ROWS = 1 << 19


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def cells(h: np.ndarray, segments: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Segment and cells within it of each 64-bit hash."""
    h = h.astype(np.int64).view(np.uint64)
    mixed = _mix(h)
    at = [(_mix(h + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(SEGMENT_CELLS)).astype(np.int64) for k in range(HASHES)]
    return (mixed % np.uint64(segments)).astype(np.int64), at


def _hits(segments: int):
    """Per chunk of rows and segment: cells hit, and cells hit more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(waiting):
            segment, at = cells(np.concatenate(waiting), segments)
            flat = np.concatenate([segment * SEGMENT_CELLS + a for a in at])
            found, n = np.unique(flat, return_counts=True)
            cut = np.searchsorted(found, np.arange(segments + 1) * SEGMENT_CELLS)
            rows = []
            for s in np.flatnonzero(np.diff(cut)):
                part = (found[cut[s] : cut[s + 1]] - s * SEGMENT_CELLS).astype(np.uint32)
                rows.append((int(s), part.tobytes(), part[n[cut[s] : cut[s + 1]] > 1].tobytes()))
            s, hit, again = zip(*rows)
            return pa.RecordBatch.from_arrays([pa.array(s, pa.int64()), pa.array(hit, pa.binary()), pa.array(again, pa.binary())], ["segment", "hit", "again"])

        waiting, n = [], 0
        for b in batches:
            if b.num_rows:
                waiting.append(b.column(0).to_numpy(zero_copy_only=False))
                n += b.num_rows
            if n >= CHUNK_ROWS:
                yield flush(waiting)
                waiting, n = [], 0
        if n:
            yield flush(waiting)

    return run


def _merge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One segment of the filter: a bit for each cell hit by at least two rows."""
    count = np.zeros(SEGMENT_CELLS, np.uint8)
    for b in batches:
        for hit, again in zip(b.column("hit"), b.column("again")):
            at = np.frombuffer(hit.as_buffer(), np.uint32)
            count[at] = np.minimum(count[at] + 1, 2)
            count[np.frombuffer(again.as_buffer(), np.uint32)] = 2
    bits = np.packbits(count == 2).tobytes()
    del count
    release()
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([bits], pa.binary())], ["segment", "bits"])


def repeated_cells(hashes: DataFrame, segments: int) -> DataFrame:
    """Pass 1 over a column of 64-bit hashes: (segment, bits) of the cells that two rows or more hit."""
    hits = hashes.mapInArrow(_hits(segments), "segment long, hit binary, again binary")
    return hits.groupBy("segment").applyInArrow(_merge, "segment long, bits binary")


def _look_up(h: np.ndarray, segments: int, bits: dict[int, np.ndarray]) -> np.ndarray:
    segment, at = cells(h, segments)
    found = np.ones(len(h), bool)
    for s in np.unique(segment):
        own = np.flatnonzero(segment == s)
        for a in at:
            cell = a[own]
            found[own] &= (bits[int(s)][cell >> 3] >> (7 - (cell & 7)) & 1).astype(bool)
    return found


def _probe(segments: int, sent):
    def run(h: pa.Array) -> pa.Array:
        bits = {s: np.frombuffer(b, np.uint8) for s, b in sent.value.items()}
        return pa.array(_look_up(h.to_numpy(zero_copy_only=False), segments, bits) if len(h) else [], pa.bool_())

    return F.arrow_udf(run, "boolean")


def _segment_of(segments: int):
    def run(h: pa.Array) -> pa.Array:
        return pa.array(cells(h.to_numpy(zero_copy_only=False), segments)[0], pa.int64())

    return F.arrow_udf(run, "long")


def _probe_segment(segments: int):
    def run(key: tuple[pa.Scalar, ...], hashes: pa.Table, bits: pa.Table) -> pa.Table:
        h = hashes.column("_hash").to_numpy()
        own = {key[0].as_py(): np.frombuffer(bits.column("bits")[0].as_buffer(), np.uint8)} if bits.num_rows else {}
        found = _look_up(h, segments, own) if len(h) else np.zeros(0, bool)
        return pa.table({"_hash": pa.array(np.unique(h[found]), pa.int64())})

    return run


def flag_repeated(df: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Add ``_repeated`` to a table with the 64-bit ``_hash`` of each row: false only for rows that are alone."""
    spark = df.sparkSession
    ship(spark)
    hashes = df.select("_hash")
    segments = max(1, -(-hashes.count() * CELLS_PER_ROW // SEGMENT_CELLS))
    bits = repeated_cells(hashes, segments)
    if segments * SEGMENT_CELLS // 8 <= filter_bytes:
        sent = spark.sparkContext.broadcast({r.segment: bytes(r.bits) for r in bits.collect()})
        return df.withColumn("_repeated", _probe(segments, sent)("_hash"))
    # The same second pass with the parts changed over: each distinct hash goes to its segment.
    slim = hashes.distinct().withColumn("segment", _segment_of(segments)("_hash"))
    found = slim.groupBy("segment").cogroup(bits.groupBy("segment")).applyInArrow(_probe_segment(segments), "_hash long")
    found = freeze(found, "repeated").withColumn("_repeated", F.lit(True))
    return df.join(found, "_hash", "left").fillna({"_repeated": False})


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """All rows and columns of ``docs``, with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when their bytes are; a null text equals the empty one. Of equal texts the row
    with the largest id stays (null ids are largest of all and give a null ``keep_id``). If whole
    rows repeat, id and text alike, one of them stays: that with the last place in the written table
    of possible repeats. Columns of any name and, as far as Parquet can hold them, type pass through. An empty table gives an empty table; the four
    new names replace columns of ``docs`` that are called so.
    """
    new = ("keep_id", "group_size", "kept", "text_sha256")
    row = F.struct(*[F.col(c) for c in docs.columns if c.lower() not in new]).alias("_row")
    rows = docs.select(row, id_of(id).alias("_id"), text_of(text).alias("_text"), F.xxhash64(text_of(text)).alias("_hash"))
    df = flag_repeated(rows, filter_bytes).withColumn("text_sha256", F.sha2(F.col("_text").cast("binary"), 256)).drop("_text", "_hash")
    alone = df.where("not _repeated").select(
        "_row.*", id_back("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    # Numbered as they are written, so that equal rows differ and copies of one text and id can be spread.
    again = freeze(df.where("_repeated").drop("_repeated").withColumn("_n", F.monotonically_increasing_id()), "repeated_rows")
    # Row groups first, so that a text with very many copies is summed up before it meets itself.
    sizes = again.groupBy("text_sha256").agg(F.max(F.struct("_id", "_n")).alias("_keep"), F.count("*").alias("group_size"))
    joined = join_classes(again, freeze(sizes, "copies"), "text_sha256", "group_size", "_n")
    stays = F.col("_n") == F.col("_keep._n")
    return alone.unionByName(joined.select("_row.*", id_back("_keep._id").alias("keep_id"), "group_size", stays.alias("kept"), "text_sha256"))
