"""Packing of tokenized documents into sequences of a fixed capacity by exact complements.

Pieces of equal length are interchangeable, so the plan is made on the counts of lengths alone: at
most ``capacity`` numbers, whatever the size of the corpus. Longest first, a length looks up the
gap it leaves in the sums of single lengths, of pairs and of triples, and as many sequences are
filled exactly as the rarest part allows. What is left is packed best-fit, longest first.

A plan says for each length which ranks go to which sequences. Pieces get their ranks from counts
by (written partition, length), so that a length that a third of all pieces have needs no single task.
"""

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorloom.llm.bpe import PIECES, Encoder, Vocabulary, alphabet
from sensorloom.llm.common import release, text_of
from sensorloom.session import freeze, ship

CAPACITY = 2048
#: Ends every document.
END = 0
#: Texts whose cuts a task remembers, at most.
KNOWN_TEXTS = 50_000

Pattern = tuple[int, ...]


# ---------------------------------------------------------------- the plan


def exact_complements(count: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """(lengths, how often) of sequences that are exactly full; takes them out of ``count``."""
    full: list[tuple[Pattern, int]] = []

    def use(*lengths: int) -> bool:
        need = {x: lengths.count(x) for x in lengths}
        n = min(int(count[x]) // k for x, k in need.items())
        if n:
            full.append((lengths, n))
            for x, k in need.items():
                count[x] -= n * k
        return n > 0

    def pairs(gap: int) -> np.ndarray:
        """Larger parts b of the pairs b + c = gap that are there, largest first."""
        b = np.arange(gap - 1, (gap + 1) // 2 - 1, -1)
        return b[(count[b] > 0) & (count[gap - b] > 0)]

    if count[capacity]:
        use(capacity)
    for a in range(capacity - 1, 0, -1):
        gap = capacity - a
        if count[a]:
            use(a, gap)
        for b in pairs(gap) if count[a] else ():
            use(a, int(b), int(gap - b))
            if not count[a]:
                break
        for b in range(min(a, gap - 2), 0, -1) if count[a] else ():
            while count[a] and count[b]:
                if not any(use(a, b, int(c), int(gap - b - c)) for c in pairs(gap - b)):
                    break
            if not count[a]:
                break
    return full


def best_fit(count: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over counts: equal sequences are handled as one group."""
    by_gap: dict[int, list[tuple[Pattern, int]]] = {}
    open_gaps = np.zeros(capacity + 1, np.int64)

    def put(pattern: Pattern, n: int) -> None:
        gap = capacity - sum(pattern)
        by_gap.setdefault(gap, []).append((pattern, n))
        open_gaps[gap] += n

    for a in range(capacity, 0, -1):
        n = int(count[a])
        while n:
            fitting = np.flatnonzero(open_gaps[a:])
            if len(fitting):
                gap = a + int(fitting[0])
                pattern, there = by_gap[gap].pop()
                used = min(n, there)
                open_gaps[gap] -= there
                if there > used:
                    put(pattern, there - used)
                put((*pattern, a), used)
                n -= used
            else:
                each = capacity // a
                if n >= each:
                    put((a,) * each, n // each)
                if n % each:
                    put((a,) * (n % each), 1)
                n = 0
    return [g for gap in sorted(by_gap) for g in by_gap[gap]]


def plan(count: np.ndarray, capacity: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first ranks of its ranges, the sequence of each first rank, and the offset there."""
    left = count.astype(np.int64).copy()
    groups = exact_complements(left, capacity) + best_fit(left, capacity)
    ranges: dict[int, list[tuple[int, int, int]]] = {}
    taken = np.zeros(capacity + 1, np.int64)
    sequence = 0
    for pattern, n in groups:
        offset = 0
        for length in pattern:
            ranges.setdefault(length, []).append((int(taken[length]), sequence, offset))
            taken[length] += n
            offset += length
        sequence += n
    assert (taken == count).all()
    return {length: tuple(np.array(x) for x in zip(*rows)) for length, rows in ranges.items()}


# ---------------------------------------------------------------- on tables


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` from 1 to ``capacity``.

    Every row gets a place, equal rows too; sequences are gapless from offset 0. Rows with a null
    length or one that fits in no sequence get nulls. An empty table stays empty. Columns called like
    the two new ones are replaced.
    """
    spark = pieces.sparkSession
    ship(spark)
    names = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    fits = F.coalesce(F.col(length).between(1, capacity), F.lit(False))
    rows = pieces.select(F.struct(*names).alias("row"), F.when(fits, F.col(length).cast("int")).alias("len"), F.spark_partition_id().alias("part"))
    rows = freeze(rows, "pieces")
    counts = freeze(rows.where("len is not null").groupBy("part", "len").count(), "lengths")
    total = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("len").agg(F.sum("count").alias("n")).collect():
        total[r.len] = r.n
    sent = spark.sparkContext.broadcast(plan(total, capacity))

    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        length, rank = (np.asarray(x.fill_null(0).to_numpy(zero_copy_only=False), np.int64) for x in (lengths, ranks))
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for n in np.unique(length):
            if n in sent.value:
                own = np.flatnonzero(length == n)
                first, base, at = sent.value[n]
                k = np.searchsorted(first, rank[own], "right") - 1
                sequence[own], offset[own] = base[k] + rank[own] - first[k], at[k]
        none = length == 0
        return pa.StructArray.from_arrays([pa.array(sequence, mask=none), pa.array(offset, mask=none)], ["sequence_id", "offset"])

    before = Window.partitionBy("len").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", "len", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("part", "len").orderBy("row")) - 1
    ranked = rows.withColumn("within", within).join(starts, ["part", "len"], "left")
    placed = ranked.select("row", F.arrow_udf(place, "sequence_id long, offset long")("len", F.col("start") + F.col("within")).alias("at"))
    return placed.select(*(F.col("row").getField(c).alias(c) for c in names), "at.*")


@lru_cache(1)
def _encoding(definition: str) -> tiktoken.Encoding:
    """The tokenizer of a byte-level vocabulary file; its ids rise with the ranks of the merges."""
    read, chars = json.loads(definition), alphabet()
    special = {t["content"]: t["id"] for t in read.get("added_tokens") or []}
    ranks = {bytes(chars[c] for c in t): i for t, i in read["model"]["vocab"].items() if t not in special}
    return tiktoken.Encoding("vocabulary", pat_str=PIECES.pattern, mergeable_ranks=ranks, special_tokens=special)


def pieces_of(docs: DataFrame, vocabulary, text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of each document's tokens and an end token: all columns but the text, and ``piece``, ``start``, ``length``, ``ids_crc32``.

    Documents longer than ``capacity`` are cut so that all pieces but the first are full. A null text
    counts as empty: its one piece is the end token. ``with_ids`` adds the tokens themselves (``ids``).
    """
    ship(docs.sparkSession)
    kind = "array<struct<start:bigint,length:bigint,ids_crc32:bigint,ids:array<int>>>"

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoding, slow, known = _encoding(vocabulary.value), None, {}

        def cut(text: str) -> tuple[list, list, list, list]:
            nonlocal slow
            try:
                found = encoding.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # its pattern gives up on a run of several hundred thousand blanks or line ends
                slow = slow or Encoder(Vocabulary(vocabulary.value))
                found = slow.encode([text])[0]
            tokens = np.append(found, np.uint32(END)).astype("<u4")
            first = len(tokens) % capacity - capacity if len(tokens) % capacity else 0
            own = [tokens[max(0, i) : i + capacity] for i in range(first, len(tokens), capacity)]
            begins = [max(0, i) for i in range(first, len(tokens), capacity)]
            return begins, [len(x) for x in own], [zlib.crc32(x.tobytes()) for x in own], [x.astype(np.int32) if with_ids else None for x in own]

        for texts in batches:
            starts, lengths, crcs, ids, n = [], [], [], [], [0]
            for t in texts:
                text = t.as_py()
                # Equal texts are cut once; only places and sums are remembered, never tokens.
                key = None if with_ids else blake2b(text.encode(), digest_size=16).digest()
                made = known.get(key) or cut(text)
                if key:
                    if len(known) >= KNOWN_TEXTS:
                        known.clear()
                    known[key] = made
                for all_of, x in zip((starts, lengths, crcs, ids), made):
                    all_of += x
                n.append(len(starts))
            fields = [pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()), pa.array(ids, pa.list_(pa.int32()))]
            yield pa.ListArray.from_arrays(pa.array(n, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "ids_crc32", "ids"]))
        del slow, known
        release()

    new = ["start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    names = [c for c in docs.columns if c != text and c.lower() not in (*new, "piece")]
    cut = docs.select(F.struct(*names).alias("_row"), F.arrow_udf(run, kind)(text_of(text)).alias("_cut"))
    cut = cut.select("_row", F.posexplode("_cut").alias("piece", "_piece"))
    return cut.select(*(F.col("_row").getField(c).alias(c) for c in names), "piece", *(F.col("_piece").getField(c).alias(c) for c in new))


def send_definition(spark: SparkSession, path: str):
    """The vocabulary file's content as a broadcast of 1.5 MB."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def pack_documents(docs: DataFrame, vocabulary, text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``pieces_of`` the documents, packed."""
    return pack(pieces_of(docs, vocabulary, text, capacity, with_ids), "length", capacity)
