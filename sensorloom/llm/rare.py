"""Probabilities of rare words among all words of their length, from counts over the whole corpus.

A word counted n times among the N running rare words of its length has (n - 1) / N, and what this leaves
over (one for each of the T different words, T / N) is dealt to all strings of that length by a byte model:
contexts of up to ``ORDER`` bytes in the word, each order smoothed with the next lower one, counted over
all different rare words. So a word seen once, or never, is judged by its spelling. The frequent words'
part of the byte model is taken out. Words of ``LENGTHS`` bytes and more are one class, with a
geometric length.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import slices
from sensorloom.session import freeze

LENGTHS = 32
#: Bytes of context. A context of so many bytes, the next byte and the order fill a number, so counts have exact keys.
ORDER = 3
#: Weight of the lower order, in observations.
SMOOTHING = 2.0
#: Bytes that a word can hold: all but the six that separate words.
BYTES = 250


def cut_out(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The slices of ``data`` as an array of binaries."""
    offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    place = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], end - begin)
    return pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[place]))])


def _flat(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    col = words.cast(pa.large_binary())
    _, places, data = col.buffers()
    offsets = np.frombuffer(places, np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)), offsets - offsets[0]


def _keys(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: key of the context, and of the context with the next byte, of every byte; 0x20 stands before a word."""
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    context = np.zeros(len(data), np.int64)
    for k in range(ORDER + 1):
        if k:
            before = np.where(place >= k, data[np.maximum(np.arange(len(data)) - k, 0)], 0x20).astype(np.int64)
            context = context | before << (8 * k)
        order = np.int64(2 * k) << 40
        yield context | order, context | data | order + (np.int64(1) << 40)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, 0):
            data, offsets = _flat(piece.column(0))
            key, n = np.unique(np.concatenate([x for pair in _keys(data, offsets) for x in pair]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], ["key", "n"])


@dataclass
class Spelling:
    """The byte model: counts by sorted key, and what lengths need to be normalised."""

    keys: np.ndarray
    counts: np.ndarray
    stop: float = 1.0  # a word of LENGTHS bytes or more ends with this probability after each byte
    free: np.ndarray | None = None  # share of each length that is not that of frequent words

    def _count(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0.0)

    def log_probabilities(self, words: pa.Array) -> np.ndarray:
        """Of each word among all strings of its length that are not frequent words."""
        data, offsets = _flat(words)
        p = np.full(len(data), 1 / BYTES)
        for context, following in _keys(data, offsets):
            p = (self._count(following) + SMOOTHING * p) / (self._count(context) + SMOOTHING)
        before = np.concatenate([[0.0], np.cumsum(np.log(p))])
        lengths = np.diff(offsets)
        log_p = np.diff(before[offsets])
        over = lengths - LENGTHS
        log_p += np.where(over >= 0, np.log(self.stop) + np.maximum(over, 0) * np.log1p(-self.stop), 0.0)
        return log_p if self.free is None else log_p - np.log(self.free[np.minimum(lengths, LENGTHS)])


@dataclass
class Sent:
    """What a task needs to score rare words by itself: all words counted more than once, and the byte model."""

    hashes: np.ndarray  # sorted
    log_p: np.ndarray
    left: np.ndarray  # by length: logarithm of what is left to the byte model
    spelling: Spelling

    def log_probabilities(self, hashes: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        words, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        begin, end = begin[first], end[first]
        out, missing = np.zeros(len(words)), np.ones(len(words), bool)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
            missing = self.hashes[at] != words
            out = self.log_p[at].astype(np.float64)
        begin, end = begin[missing], end[missing]
        out[missing] = self.left[np.minimum(end - begin, LENGTHS)] + self.spelling.log_probabilities(cut_out(data, begin, end))
        return out[which]


@dataclass
class RareWords:
    table: DataFrame  # (word, log_p): the words counted more than once
    left: np.ndarray
    spelling: Spelling

    def send(self, limit: int) -> Sent | None:
        """All for the tasks if there are at most ``limit`` words in the table."""
        if self.table.count() > limit:
            return None
        rows = self.table.select("word", F.col("log_p").cast("float").alias("log_p")).toArrow()
        hashes = rows.column("word").to_numpy().view(np.uint64)
        order = np.argsort(hashes)
        return Sent(hashes[order], rows.column("log_p").to_numpy()[order], self.left, self.spelling)

    def log_probabilities(self, words: DataFrame) -> DataFrame:
        """``words(word, spelt, ...)`` with ``log_p``, the logarithm of the probability among words of that length."""
        joined = words.join(self.table, "word", "left")
        unseen = _spelt(joined, F.when(F.col("log_p").isNull(), F.col("spelt")), self.left, self.spelling)
        return joined.withColumn("log_p", F.coalesce("log_p", unseen))


def _spelt(words: DataFrame, spelt: Column, left: np.ndarray, spelling: Spelling) -> Column:
    """Logarithm of what the byte model deals to a word; null for null."""
    sent = words.sparkSession.sparkContext.broadcast((left, spelling))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        left, spelling = sent.value
        for w in batches:
            # A word that stands in many texts is spelt out once a batch.
            d = w.dictionary_encode()
            pieces = [spelling.log_probabilities(s.column(0)) for s in slices(pa.RecordBatch.from_arrays([d.dictionary], ["w"]), 0)]
            lengths = np.diff(_flat(d.dictionary)[1])
            p = pa.array(np.concatenate([np.zeros(0), *pieces]) + left[np.minimum(lengths, LENGTHS)])
            yield p.take(d.indices)

    return F.arrow_udf(run, "double")(spelt)


def count(words: DataFrame, frequent: list[bytes]) -> RareWords:
    """From a written table ``words(word, n, spelt)`` of different rare words."""
    length = F.least(F.length("spelt"), F.lit(LENGTHS))
    sums = words.groupBy(length.alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("t"), F.sum(F.length("spelt") - length).alias("over")).collect()
    grams = words.select("spelt").mapInArrow(_counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    keys, counts = grams.column("key").to_numpy(), grams.column("n").to_numpy()
    order = np.argsort(keys)
    n, over = next(((r.t, r.over) for r in sums if r.k == LENGTHS), (0, 0))
    spelling = Spelling(keys[order], counts[order].astype(np.float64), (n + 1) / (n + over + 2))
    free = np.ones(LENGTHS + 1)
    if frequent:
        own = np.exp(spelling.log_probabilities(pa.array(frequent, pa.binary())))
        np.subtract.at(free, [min(len(w), LENGTHS) for w in frequent], own)
    spelling.free = np.maximum(free, 1e-12)
    # Without counts of a length all is left to the spelling.
    left, running = np.zeros(LENGTHS + 1), np.ones(LENGTHS + 1)
    for r in sums:
        left[r.k], running[r.k] = np.log(r.t / r.n), r.n
    again = words.where("n > 1")
    dealt = _spelt(again, F.col("spelt"), left, spelling)
    total = F.element_at(F.array(*(F.lit(float(x)) for x in running)), (length + 1).cast("int"))
    again = again.select("word", F.log((F.col("n") - 1) / total).alias("counted"), dealt.alias("dealt"))
    top, low = F.greatest("counted", "dealt"), F.least("counted", "dealt")
    return RareWords(freeze(again.select("word", (top + F.log1p(F.exp(low - top))).alias("log_p")), "rare"), left, spelling)
