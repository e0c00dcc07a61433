"""Hashed byte and word n-grams of whole texts, and bounded training samples."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm import words as W
from sensorloom.llm.common import flat_bytes, release, slices

#: 16,384 buckets.
BITS = 14
#: ASCII characters that are no letters become blanks.
LETTERS = np.arange(256, dtype=np.uint8)
LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 32
AS_IS = np.arange(256, dtype=np.uint8)

Part = tuple[np.ndarray, np.ndarray, np.ndarray]


def byte_grams(data: np.ndarray, offsets: np.ndarray, n: int) -> Part:
    """Buckets of all runs of n bytes, and where those of each text begin and end."""
    size = max(0, len(data) - n + 1)
    h = np.full(size, n * 0x9E3779B1 & 0xFFFFFFFF, np.uint32)
    for k in range(n):
        h = (h ^ data[k : k + size]) * np.uint32(0x01000193)
    bucket = ((h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
    begin = np.minimum(offsets[:-1], size)
    return bucket, begin, np.clip(offsets[1:] - n + 1, begin, size)


def word_grams(data: np.ndarray, offsets: np.ndarray) -> list[Part]:
    """Words, and pairs of neighbours regardless of their order; a word beside itself always gives the same pair."""
    begin, end, first = W.spans(data, offsets)
    h = W.word_hashes(data, begin, end)
    pair = W.mix((h[:-1] ^ h[1:]) + np.uint64(1)) if len(h) else h
    last = np.clip(first[1:] - 1, 0, len(pair))
    bucket = lambda x: (x >> np.uint64(64 - BITS)).astype(np.uint32)
    return [(bucket(h), first[:-1], first[1:]), (bucket(pair), np.minimum(first[:-1], last), last)]


def parts(texts: pa.Array, orders: tuple[int, ...], fold: np.ndarray, with_words: bool) -> list[Part]:
    """All features of a slice of texts, after lower-casing; a null text has none."""
    data, offsets = flat_bytes(pc.utf8_lower(texts.fill_null("")))
    data = fold[data]
    found = [byte_grams(data, offsets, n) for n in orders]
    return found + word_grams(data, offsets) if with_words else found


def sums(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sum of each slice of ``values``."""
    if not len(values) or not len(begin):
        return np.zeros(len(begin))
    edges = np.column_stack([begin, end]).ravel()
    out = np.add.reduceat(np.append(values, np.zeros(1, values.dtype)), edges, dtype=np.float64)[::2]
    return np.where(end > begin, out, 0.0)


def means(found: list[Part], weights: np.ndarray) -> np.ndarray:
    """For each text the mean weight of its features, for each column of ``weights``."""
    n = sum((end - begin for _, begin, end in found), np.zeros(len(found[0][1]), np.int64))
    total = [sum(sums(w[bucket], begin, end) for bucket, begin, end in found) for w in np.ascontiguousarray(weights.T)]
    return np.column_stack(total) / np.maximum(n, 1)[:, None]


def histograms(found: list[Part]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text the buckets that occur and their shares."""
    for k in range(len(found[0][1])):
        count = sum(np.bincount(bucket[begin[k] : end[k]], minlength=1 << BITS) for bucket, begin, end in found)
        at = np.flatnonzero(count)
        yield at.astype(np.uint16), (count[at] / max(1, count.sum())).astype(np.float32)


def share(id: str, salt: int) -> Column:
    """A number from 0 to 1 that only depends on the id."""
    return F.pmod(F.xxhash64(id, F.lit(salt)), F.lit(1 << 30)) / F.lit(float(1 << 30))


def bounded_sample(rows: DataFrame, label: str, id: str, most: int) -> DataFrame:
    """About ``most`` rows of each label at the most, chosen by a hash of the id: a fixed share of each label."""
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if not counts:
        return rows.limit(0)
    keep = F.lit(False)
    for value, n in counts.items():
        keep = F.when(F.col(label) == F.lit(value), share(id, 7) < most / n).otherwise(keep)
    return rows.where(keep)


def training_set(sample: DataFrame, label: str, text: str, of: Callable[[pa.Array], list[Part]]) -> tuple[np.ndarray, list]:
    """Labels and histograms of a bounded sample; the histograms are made on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 1, 1 << 20):
                hists = list(histograms(of(piece.column(1))))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([a.tobytes() for a, _ in hists], pa.binary()), pa.array([v.tobytes() for _, v in hists], pa.binary())],
                    ["label", "at", "value"],
                )
        release()

    kind = dict(sample.dtypes)[label]
    got = sample.select(label, text).mapInArrow(run, f"label {kind}, at binary, value binary").toArrow()
    rows = [(np.frombuffer(a, np.uint16), np.frombuffer(v, np.float32)) for a, v in zip(got.column("at").to_pylist(), got.column("value").to_pylist())]
    # The order of rows must not depend on the cluster.
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0].tobytes(), rows[i][1].tobytes(), str(got.column("label")[i])))
    return np.array(got.column("label").to_pylist(), object)[order], [rows[i] for i in order]


def dense(rows: list, at: np.ndarray) -> np.ndarray:
    out = np.zeros((len(at), 1 << BITS), np.float32)
    for i, k in enumerate(at):
        out[i, rows[k][0]] = rows[k][1]
    return out


def adam(params: list[np.ndarray], rate: float) -> Callable[[list[np.ndarray]], None]:
    """A step function that changes ``params`` in place."""
    first, second, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], [0]

    def step(grads):
        t[0] += 1
        for p, g, m, v in zip(params, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9 ** t[0])) / (np.sqrt(v / (1 - 0.999 ** t[0])) + 1e-8)

    return step
