"""URL filter: rules first, and for the other URLs a ratio of two character language models.

The rules label a part of the URLs. On these, two variable-order Markov models over bytes are counted,
one of accepted and one of rejected URLs: each order is smoothed with the next lower one, so that a
context counts as far as it has been seen. A URL's score is the difference of its two log-likelihoods
a character; the threshold is calibrated on labelled URLs that the models have not seen.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import flat_bytes, slices
from sensorloom.session import ship

#: (verdict, host and path): a rule fits its host and all subdomains where the path begins with its path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
ORDER = 5
#: Different keys that a task holds before it passes their counts on.
HELD_KEYS = 1 << 19
#: Bytes of URLs whose keys are sorted at a time.
KEYED_BYTES = 1 << 18
#: Weight of the lower order, in observations.
SMOOTHING = 2.0
#: Share of the labelled URLs that calibrate the threshold.
HELD_OUT = 0.2
BIN = 0.001
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and all that follows the first ``://``; without it (or a url) host and path are empty."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), rest


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for what, r in sorted(rules, key=lambda x: len(x[1])):
        name, slash, tail = r.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + tail)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _keys(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each order: places with so long a context, key of the context, key of the context with the next byte.

    Keys are numbers of their own: up to six bytes, and above them how many and of which kind.
    """
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for k in range(ORDER + 1):
        at = np.flatnonzero(place >= k)
        context = np.zeros(len(at), np.int64)
        for j in range(k, 0, -1):
            context = context << 8 | data[at - j]
        yield at, context | (2 * k << 48), context << 8 | data[at] | (2 * k + 1 << 48)


def _framed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each URL with an end mark."""
    data, offsets = flat_bytes(texts)
    return np.insert(data, offsets[1:], 3), offsets + np.arange(len(offsets))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, accepted, rejected), a key once or more a task."""

    def out(keys, count):
        count = count.astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(count[0]), pa.array(count[1])], ["key", "accepted", "rejected"])

    keys, count = np.zeros(0, np.int64), np.zeros((2, 0))
    for batch in batches:
        for piece in slices(batch, 0, KEYED_BYTES):
            data, offsets = _framed(piece.column(0))
            rejected = np.repeat(piece.column(1).to_numpy(zero_copy_only=False), np.diff(offsets))
            found = [(k, rejected[at]) for at, *both in _keys(data, offsets) for k in both]
            new, of = np.concatenate([k for k, _ in found]), np.concatenate([r for _, r in found])
            keys, which = np.unique(np.concatenate([keys, new]), return_inverse=True)
            count = np.stack([np.bincount(which, np.concatenate([count[m], of == m]), len(keys)) for m in (0, 1)])
            if len(keys) > HELD_KEYS:
                yield out(keys, count)
                keys, count = keys[:0], count[:, :0]
    yield out(keys, count)


@dataclass
class Counts:
    """Counts of both models by sorted key; keys that were not seen count 0."""

    keys: np.ndarray
    count: np.ndarray

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros((2, len(keys)))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.count[:, at], 0)


def train(urls: DataFrame) -> Counts:
    """Counts of both models over all rows of ``urls(text, rejected)``, one for each key that occurs."""
    per_task = urls.select("text", F.col("rejected").cast("int")).mapInArrow(_counted, "key long, accepted long, rejected long")
    got = per_task.groupBy("key").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected")).toArrow()
    keys = got.column("key").to_numpy()
    order = np.argsort(keys)
    return Counts(keys[order], np.stack([got.column(n).to_numpy()[order] for n in ("accepted", "rejected")]).astype(np.float32))


def log_ratio(counts: Counts, texts: pa.Array) -> np.ndarray:
    """Difference of the log-likelihoods a character, end mark included; 0 for an empty text."""
    data, offsets = _framed(texts)
    p = np.full((2, len(data)), 1 / 256)
    for at, context, following in _keys(data, offsets):
        p[:, at] = (counts.of(following) + SMOOTHING * p[:, at]) / (counts.of(context) + SMOOTHING)
    logs = np.log(p)
    length = np.diff(offsets)
    total = np.add.reduceat(np.append(logs[0] - logs[1], 0.0), offsets[:-1]) if len(length) else np.zeros(0)
    return np.where(length > 1, total / length, 0.0)


def threshold_of(bins: list[tuple[int, bool, int]]) -> float:
    """The score that best divides accepted from rejected, both weighing alike; the middle of the best, nearest to 0."""
    n = {True: 0, False: 0}
    for _, rejected, k in bins:
        n[rejected] += k
    if not n[True] or not n[False]:
        return 0.0
    low, high = min(b for b, _, _ in bins), max(b for b, _, _ in bins) + 1
    share = np.zeros((2, high - low))
    for b, rejected, k in bins:
        share[int(rejected), b - low] += k / n[rejected]
    # Allowed from bin i on.
    good = share[0].sum() - np.concatenate([[0], np.cumsum(share[0])]) + np.concatenate([[0], np.cumsum(share[1])])
    best = np.flatnonzero(good >= good.max() - 1e-12)
    runs = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)
    middles = [(r[0] + r[-1]) / 2 + low for r in runs]
    return float(min(middles, key=abs) * BIN)


def filter_urls(pages: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """All rows and columns with ``host``, ``path``, ``rule``, ``verdict`` and ``score`` added.

    A null url, or one without ``://``, has empty host and path, no rule, and score 0. Without labelled
    URLs of both kinds the scores are what the one model or none gives, and the threshold is 0. Columns
    called like the new ones are replaced; an empty table stays empty.
    """
    spark = pages.sparkSession
    ship(spark)
    host, path, rest = host_and_path(F.col(url))
    rule, verdict = rule_of(host, path, rules)
    labelled = pages.select(rest.alias("text"), (verdict == "block").alias("rejected")).where("rejected is not null")
    held_out = F.pmod(F.xxhash64("text", F.lit(5)), F.lit(1000)) < int(1000 * HELD_OUT)
    sent = spark.sparkContext.broadcast(train(labelled.where(~held_out)))

    def run(texts: pa.Array) -> pa.Array:
        table = pa.RecordBatch.from_arrays([texts], ["t"])
        return pa.array(np.concatenate([np.zeros(0), *(log_ratio(sent.value, s.column(0)) for s in slices(table, 0))]))

    score = F.arrow_udf(run, "double")
    bins = labelled.where(held_out).select(F.floor(score("text") / BIN).cast("int").alias("bin"), "rejected").groupBy("bin", "rejected").count()
    threshold = threshold_of([tuple(r) for r in bins.collect()])
    names = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict", "score")]
    judged = pages.select(*names, host.alias("host"), path.alias("path"), rule.alias("rule"), verdict.alias("verdict"), score(rest).alias("score"))
    return judged.withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") >= threshold, "allow").otherwise("block")))
