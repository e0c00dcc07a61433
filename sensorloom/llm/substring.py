"""Repeated passages across documents, by fixed-block anchors.

A passage is ``WINDOW`` words or more. Every document is cut into blocks of half that length, one
after the other, so that any window holds a whole block. The blocks are the index; every rolling
run of a block's length is a probe. A run that equals a block of another document is an anchor,
and it is extended: the windows around anchors are looked up whole, and words of windows that also
begin in a document with a smaller id are removed. Windows beside each other add up to maximal
repeats.

Documents are placed by batch in a bucketed table, once. A batch sends each different hash once to
its owner (4 bytes for a probe, 8 for a window) and gets one bit back in the same order, so that
a run in very many documents is one entry a batch, and neither pairs of documents nor their texts
are ever sent. Whether a run is an anchor may err on the side of yes, by the 4-byte hash; whether a
window is repeated rests on 64 bits and the owner, which a second hash chooses.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.llm import words as W
from sensorloom.llm.common import NULL_ID, flat_bytes, id_of, release, slices, text_of
from sensorloom.session import freeze, ship

WINDOW = 50
#: Bytes of text in a batch, and of hashes of all batches at an owner, about.
BATCH_BYTES = 2 << 20
OWNER_BYTES = 16 << 20
NEW = ("n_words", "n_removed", "kept_text", "removed_spans")
ENTRIES = "batch int, owner int, hashes binary, least binary"


class Batch:
    """Documents of one batch in order of id, and the hashes of their words."""

    def __init__(self, table: pa.Table, window: int):
        self.table = table.sort_by([("_id", "ascending"), ("_text", "ascending")]).combine_chunks()
        self.ids = self.table.column("_id").to_numpy()
        self.window, self.block = window, window // 2
        hashes, counts = [], []
        for batch in self.table.select(["_text"]).to_batches():
            for part in slices(batch, 0):
                data, offsets = flat_bytes(part.column(0))
                begin, end, first = W.spans(data, offsets)
                hashes.append(W.word_hashes(data, begin, end))
                counts.append(np.diff(first))
        self.words = np.concatenate([np.zeros(0, np.uint64), *hashes])
        self.counts = np.concatenate([np.zeros(0, np.int64), *counts])
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        # One number a word each: four bytes are enough within a batch.
        self.doc = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.counts)
        self.place = np.arange(len(self.words), dtype=np.int32) - self.first[self.doc].astype(np.int32)
        self.left = self.counts[self.doc].astype(np.int32) - self.place

    def at(self, length: int) -> np.ndarray:
        """Where a run of so many words begins that does not leave its document."""
        return np.flatnonzero(self.left >= length)

    def probes(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the rolling runs begin, and their 64-bit hashes."""
        at = self.at(self.block)
        # A document shorter than a window can hold no repeat.
        at = at[self.counts[self.doc[at]] >= self.window]
        return at, W.runs(self.words, at, at + self.block, 1)

    def windows(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the windows around anchors begin, their hashes, and another hash of them."""
        reach = np.zeros(len(self.words) + 1, np.int32)
        begin = np.maximum(anchors - (self.window - self.block), self.first[self.doc[anchors]])
        np.add.at(reach, begin, 1)
        np.add.at(reach, anchors + 1, -1)
        at = np.flatnonzero((np.cumsum(reach[:-1]) > 0) & (self.left >= self.window)) if len(self.words) else anchors
        return at, W.runs(self.words, at, at + self.window, 2), W.runs(self.words, at, at + self.window, 3)

    def covered(self, at: np.ndarray) -> np.ndarray:
        """Words within a window that begins at one of the places."""
        reach = np.zeros(len(self.words) + self.window + 1, np.int32)
        reach[at] += 1
        reach[at + self.window] -= 1
        return np.cumsum(reach)[: len(self.words)] > 0


def _entries(number: int, owner: np.ndarray, hashes: np.ndarray, least: np.ndarray) -> pa.Table:
    """One row an owner from entries that are sorted by it."""
    owners, first = np.unique(owner, return_index=True)
    last = [*first[1:], len(owner)]
    packed = lambda a: pa.array([a[i:j].tobytes() for i, j in zip(first, last)], pa.binary())
    return pa.table([pa.array(np.full(len(owners), number), pa.int32()), pa.array(owners.astype(np.int32)), packed(hashes), packed(least)], ["batch", "owner", "hashes", "least"])


def _probe_order(batch: Batch, owners: int):
    """Different probes in the order they are sent in, and which of them each run is.

    Per probe also whether it is a block, and whether two documents of the batch have it.
    """
    at, h = batch.probes()
    owner = (h >> np.uint64(32)) % np.uint64(owners)
    key = owner << np.uint64(32) | h & np.uint64(0xFFFFFFFF)
    found, which = np.unique(key, return_inverse=True)
    block = np.zeros(len(found), bool)
    block[which[batch.place[at] % batch.block == 0]] = True
    low, high = np.full(len(found), len(batch.ids), np.int32), np.full(len(found), -1, np.int32)
    np.minimum.at(low, which, batch.doc[at])
    np.maximum.at(high, which, batch.doc[at])
    return at, which, found, block, low < high


def _window_order(batch: Batch, owners: int, anchors: np.ndarray):
    """Different windows in the order they are sent in, which of them each window is, and their least document."""
    at, h, other = batch.windows(anchors)
    owner = (other % np.uint64(owners)).astype(np.int64)
    # ``at`` runs by document, so the first of equal windows lies in the least one.
    found, first, which = np.unique(h, return_index=True, return_inverse=True)
    own, least = owner[first], batch.doc[at[first]]
    order = np.lexsort((found, least, own))
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return at, back[which], own[order], found[order], least[order]


def _bits(replies: pa.Table, kind: int, n: int) -> np.ndarray:
    """The replies of all owners, joined in the order of the entries."""
    rows = sorted((o, n, b) for k, o, n, b in zip(*(replies.column(c).to_pylist() for c in ("kind", "owner", "n", "bits"))) if k == kind)
    parts = [np.unpackbits(np.frombuffer(b, np.uint8), count=m).astype(bool) for _, m, b in rows]
    out = np.concatenate([np.zeros(0, bool), *parts])
    assert len(out) == n, "a reply is missing"
    return out


def _send_probes(window: int, owners: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        batch = Batch(docs, window)
        _, _, found, block, many = _probe_order(batch, owners)
        flags = (block | many << 1).astype(np.uint8)
        release()
        return _entries(key[0].as_py(), (found >> np.uint64(32)).astype(np.int64), found.astype(np.uint32), flags)

    return run


def _answer_probes(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Which probes equal a block and lie in two documents or more; one bit each."""
    hashes = [np.frombuffer(x.as_buffer(), np.uint32) for x in rows.column("hashes")]
    flags = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8) for x in rows.column("least")])
    ends = np.cumsum([len(h) for h in hashes])
    found, which = np.unique(np.concatenate(hashes), return_inverse=True)
    block, many = np.zeros(len(found), bool), np.bincount(which, minlength=len(found)) > 1
    block[which[flags & 1 > 0]] = True
    many[which[flags & 2 > 0]] = True
    return _replies(key, rows, (block & many)[which], ends, 1)


def _replies(key, rows: pa.Table, yes: np.ndarray, ends: np.ndarray, kind: int) -> pa.Table:
    parts = np.split(yes, ends[:-1])
    n = rows.num_rows
    release()
    return pa.table(
        [rows.column("batch").combine_chunks(), pa.array([kind] * n, pa.int32()), pa.array([key[0].as_py()] * n, pa.int32())]
        + [pa.array([len(p) for p in parts], pa.int64()), pa.array([np.packbits(p).tobytes() for p in parts], pa.binary())],
        ["batch", "kind", "owner", "n", "bits"],
    )


def _send_windows(window: int, owners: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, replies: pa.Table) -> pa.Table:
        batch = Batch(docs, window)
        at, which, found, _, _ = _probe_order(batch, owners)
        anchors = at[_bits(replies, 1, len(found))[which]]
        _, _, own, hashes, least = _window_order(batch, owners, anchors)
        release()
        return _entries(key[0].as_py(), own, hashes, batch.ids[least])

    return run


def _answer_windows(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Whether a document with a smaller id than any of the batch's has the window; one bit each."""
    hashes = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("hashes")]
    least = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in rows.column("least")])
    ends = np.cumsum([len(h) for h in hashes])
    found, which = np.unique(np.concatenate(hashes), return_inverse=True)
    smallest = np.full(len(found), NULL_ID)
    np.minimum.at(smallest, which, least)
    return _replies(key, rows, smallest[which] < least, ends, 2)


def _remove(window: int, owners: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, replies: pa.Table) -> pa.Table:
        batch = Batch(docs, window)
        at, which, found, _, _ = _probe_order(batch, owners)
        anchors = at[_bits(replies, 1, len(found))[which]]
        at, which, _, hashes, least = _window_order(batch, owners, anchors)
        elsewhere = _bits(replies, 2, len(hashes))[which]
        # Beyond the batch's least document with the window, that document itself is the smaller one.
        here = batch.ids[batch.doc[at]] > batch.ids[least][which] if len(at) else elsewhere
        gone = batch.covered(at[elsewhere | here])
        kept, runs_out, removed = [], [], []
        for k, text in enumerate(batch.table.column("_text")):
            own = gone[batch.first[k] : batch.first[k + 1]]
            pieces = text.as_py().split()
            kept.append(b" ".join(w for w, g in zip(pieces, own) if not g) if own.any() else b" ".join(pieces))
            edge = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]])))
            runs_out.append([{"begin": int(i), "end": int(j)} for i, j in edge.reshape(-1, 2)])
            removed.append(int(own.sum()))
        release()
        spans = pa.array(runs_out, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])))
        extra = [pa.array(batch.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), spans]
        return pa.table([*(batch.table.column(n) for n in ("_row", "_text", "_null")), *extra], ["_row", "_text", "_null", *NEW])

    return run


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` with ``n_words``, ``n_removed``, ``kept_text`` and ``removed_spans``.

    ``kept_text`` joins the kept words by one blank; ``removed_spans`` lists the word ranges that went.
    A word goes if a window that covers it also begins in a row with a smaller id; windows are those of
    the input. Rows with equal ids don't remove each other's words, null ids are larger than all others. A null text has no words.
    An empty table gives an empty table; the four new names replace columns that are called so.
    """
    spark = docs.sparkSession
    ship(spark)
    size = docs.select(F.sum(F.octet_length(text_of(text)))).first()[0] or 0
    batches, owners = max(1, -(-size // BATCH_BYTES)), max(1, -(-size // OWNER_BYTES))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-batches // 8))
    # The other columns travel as one, so that their names meet none of ours.
    names = [c for c in docs.columns if c.lower() not in NEW]
    whole = docs.select(
        F.struct(*(c for c in names if c != text)).alias("_row"),
        F.col(text).isNull().alias("_null"),
        text_of(text).cast("binary").alias("_text"),
        id_of(id).alias("_id"),
        F.pmod(F.xxhash64(id, text), F.lit(batches)).cast("int").alias("batch"),
    )
    name = f"placed_{uuid.uuid4().hex}"
    whole.repartition(parts, "batch").write.option("compression", "zstd").bucketBy(parts, "batch").saveAsTable(name)
    placed = spark.table(name)
    slim = placed.select("batch", "_id", "_text")

    probes = slim.groupBy("batch").applyInArrow(_send_probes(window, owners), ENTRIES)
    reply = "batch int, kind int, owner int, n bigint, bits binary"
    anchors = freeze(probes.groupBy("owner").applyInArrow(_answer_probes, reply), "anchors")
    found = slim.groupBy("batch").cogroup(anchors.groupBy("batch")).applyInArrow(_send_windows(window, owners), ENTRIES)
    replies = anchors.unionByName(freeze(found.groupBy("owner").applyInArrow(_answer_windows, reply), "repeats"))
    added = T.StructType.fromDDL("n_words bigint, n_removed bigint, kept_text string, removed_spans array<struct<begin:bigint,end:bigint>>")
    schema = T.StructType([*placed.select("_row", "_text", "_null").schema.fields, *added.fields])
    done = placed.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(_remove(window, owners), schema)
    own = F.when(~F.col("_null"), F.col("_text").cast("string")).alias(text)
    return done.select(*(own if c == text else F.col("_row").getField(c).alias(c) for c in names), *NEW)
