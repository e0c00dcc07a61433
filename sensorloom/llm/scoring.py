"""Language-model scores by masked pseudo-likelihood.

A network reads the two words on each side of a masked word and predicts it; a document's score is the
sum of the log-probabilities of all its words, each given its neighbours. The network is trained in
numpy on every word of every document: each task runs Adam over its own part from common
first weights, and the weights are averaged by the number of words, in two steps, over all tasks.

The network's tokens are the words that are most frequent over all documents, and the lengths of all
other words. They are sorted by frequency and cut into equal classes; the probability of a token is
that of its class times that within the class. A rare word has the probability of its length's token
times its own among all words of that length, from counts of every word of the corpus (``rare``). Both are
normalised exactly. The rare words' table grows with the corpus: up to ``SENT_WORDS`` it is sent to all
tasks, beyond that it stays in Spark and the words of the texts are joined to it, with the same results.
"""

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm import rare
from sensorloom.llm import words as W
from sensorloom.llm.common import flat_bytes, slices, text_of
from sensorloom.llm.features import adam
from sensorloom.session import freeze, ship

CLASSES = 32
#: Words that are tokens by themselves, and tokens for the lengths of the others.
FREQUENT, LENGTHS = 992, rare.LENGTHS
SIZE = FREQUENT + LENGTHS
OFFSETS = (-2, -1, 1, 2)
DIMENSIONS, HIDDEN = 16, 32
BATCH = 1024
RATE = 0.01
#: Different words that a task holds before it passes their counts on, and bytes of them.
HELD_WORDS, HELD_BYTES = 1 << 19, 16 << 20
#: Rare words that are sent to all tasks (64 MB); more are joined.
SENT_WORDS = (64 << 20) // 12
#: Weights travel in pieces of so many numbers, summed by so many groups of tasks first.
PIECE, GROUPS = 4096, 64

SHAPES = (
    ("embedding", (SIZE + 1, DIMENSIONS)),  # the last one stands beyond the ends of a document
    ("context", (len(OFFSETS) * DIMENSIONS, HIDDEN)),
    ("hidden_bias", (HIDDEN,)),
    ("classes", (HIDDEN, CLASSES)),
    ("class_bias", (CLASSES,)),
    ("members", (CLASSES, HIDDEN, SIZE // CLASSES)),
    ("member_bias", (CLASSES, SIZE // CLASSES)),
)


class Network:
    """The weights, as views of one flat vector."""

    def __init__(self, flat: np.ndarray | None = None):
        size = sum(int(np.prod(s)) for _, s in SHAPES)
        self.flat = np.random.default_rng(23).normal(0, 0.1, size).astype(np.float32) if flat is None else flat.astype(np.float32, copy=False)
        at = 0
        for name, shape in SHAPES:
            n = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + n].reshape(shape))
            at += n

    def hidden(self, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.embedding.take(around.ravel(), axis=0).reshape(len(around), -1)
        h = x @ self.context
        h += self.hidden_bias
        return x, np.tanh(h, out=h)

    def log_probabilities(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of each target word, given the words around it."""
        # Sorted by class once, the members of each class are slices.
        order, cls, member, cut = _by_class(target)
        _, h = self.hidden(around.take(order, axis=0))
        z = h @ self.classes
        log_p = _log_share(z, self.class_bias[:, None], cls)
        for some, rows, theirs, own in _groups(cut):
            z[theirs] = (h[rows] @ self.members[some]).reshape(-1, z.shape[-1])[own]
        log_p += _log_share(z, self.member_bias.T.take(cls, axis=1), member)
        out = np.empty_like(log_p)
        out[order] = log_p
        return out

    def gradient(self, around: np.ndarray, target: np.ndarray, into: "Network | None" = None) -> np.ndarray:
        """Of the mean negative log-probability, as one flat vector."""
        out, n = into or Network(np.empty_like(self.flat)), len(target)
        out.flat[...] = 0
        order, cls, member, cut = _by_class(target)
        near = around.take(order, axis=0)
        x, h = self.hidden(near)
        # Hidden values lie between -1 and 1, which bounds all scores: exponentials of small scores need no shift.
        bound = max((np.ones(HIDDEN, w.dtype) @ np.abs(w) + np.abs(b)).max() for w, b in ((self.classes, self.class_bias), (self.members, self.member_bias)))
        g = h @ self.classes
        g += self.class_bias
        _softmax(g, n, cls, bound)
        np.matmul(h.T, g, out=out.classes)
        g.sum(axis=0, out=out.class_bias)
        back = g @ self.classes.T
        groups = list(_groups(cut))
        g = np.empty_like(back)
        for some, rows, theirs, own in groups:
            g[theirs] = (h[rows] @ self.members[some]).reshape(-1, g.shape[-1])[own]
        g += self.member_bias.take(cls, axis=0)
        _softmax(g, n, member, bound)
        for some, rows, theirs, own in groups:
            seen, part = h[rows], g[theirs]
            if isinstance(own, np.ndarray):
                part = np.zeros(seen.shape[:-1] + part.shape[-1:], part.dtype)
                part.reshape(-1, part.shape[-1])[own] = g[theirs]
            out.members[some] = np.swapaxes(seen, -1, -2) @ part
            out.member_bias[some] = part.sum(axis=-2)
            back[theirs] += (part @ np.swapaxes(self.members[some], -1, -2)).reshape(-1, HIDDEN)[own]
        h *= h
        np.subtract(1, h, out=h)
        back *= h
        np.matmul(x.T, back, out=out.context)
        back.sum(axis=0, out=out.hidden_bias)
        to_words = (back @ self.context.T).reshape(-1, DIMENSIONS)
        # Rows of equal words are added up by sorting the words, not number by number.
        words = near.astype(np.int16).ravel()
        sort = np.argsort(words, kind="stable")
        words = words[sort]
        first = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
        out.embedding[words[first]] = np.add.reduceat(to_words.take(sort, axis=0), first, axis=0)
        return out.flat


def _by_class(target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Order by class, class and member of each word in that order, and where each class begins."""
    target = target.astype(np.int16)
    cls = target // (SIZE // CLASSES)
    order = np.argsort(cls.astype(np.int8), kind="stable")
    member = (target - cls * (SIZE // CLASSES))[order]
    cls = cls[order]
    return order, cls, member, np.searchsorted(cls, np.arange(CLASSES + 1, dtype=np.int16)).tolist()


def _groups(cut: list[int]) -> Iterator[tuple]:
    """Classes that are handled together: (classes, rows by class and place, rows that are theirs, places of these).

    Classes of about as many rows share one call; the shorter ones are filled up with other rows. A class alone is a slice.
    """
    sizes: dict[int, list[int]] = {}
    for c, (i, j) in enumerate(zip(cut, cut[1:])):
        if i < j:
            sizes.setdefault(max(j - i - 1, 7).bit_length(), []).append(c)
    begin = np.array(cut)
    for some in sizes.values():
        if len(some) == 1:
            rows = slice(cut[some[0]], cut[some[0] + 1])
            yield some[0], rows, rows, slice(None)
        else:
            some = np.array(some)
            count = begin[some + 1] - begin[some]
            place = np.arange(count.max())
            own = np.flatnonzero((place < count[:, None]).ravel())
            rows = np.minimum(begin[some][:, None] + place, cut[-1] - 1)
            yield some, rows, rows.ravel()[own], own


#: exp of scores up to here is far from the limits of a float.
SAFE = 40.0


def _log_share(z: np.ndarray, bias: np.ndarray, column: np.ndarray) -> np.ndarray:
    """For each row of ``z`` the logarithm of the share that the given column has in its exponentials.

    ``bias`` is added first; it has a row for each column of ``z``.
    """
    # With the rows turned into columns, the largest number and the sum of each are found faster.
    z = np.add(z.T, bias, order="C")
    right, top = z[column, np.arange(z.shape[1])], z.max(axis=0)
    z -= top
    np.exp(z, out=z)
    # Added up by eighths and then in pairs, in the order in which numpy sums a row.
    total = z[:8].copy()
    for i in range(8, len(z), 8):
        total += z[i : i + 8]
    while len(total) > 1:
        total = total[::2] + total[1::2]
    return right - (top + np.log(total[0]))


def _places(z: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Of one number in each row of ``z``, when its rows stand one behind the other."""
    return np.arange(0, z.size, z.shape[1]) + column


def _softmax(z: np.ndarray, n: int, right: np.ndarray, bound: float) -> None:
    """From scores to the gradient of the mean loss over n rows, in place."""
    if bound > SAFE:
        z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    total = z.sum(axis=1, keepdims=True)
    total *= n
    z /= total
    z.ravel()[_places(z, right)] -= np.float32(1 / n)


@dataclass
class Vocabulary:
    hashes: np.ndarray  # of the frequent words, sorted
    rank: np.ndarray  # their place by frequency
    rare: "rare.RareWords | None" = None  # probabilities of all other words among those of their length

    def tokens(self, hashes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Frequent words by rank; the others by length, from the end of the vocabulary on."""
        out = SIZE - 1 - np.minimum(lengths, LENGTHS) + 1
        if len(self.hashes):
            at = self._places(hashes)
            out = np.where(self.hashes[at] == hashes, self.rank[at], out)
        return out

    @cached_property
    def _begin(self) -> np.ndarray:
        """Where the hashes with each beginning of 16 bits begin."""
        return np.searchsorted(self.hashes >> np.uint64(48), np.arange(1 << 16, dtype=np.uint64))

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        """Where each hash stands, if it is there."""
        last = len(self.hashes) - 1
        at = np.minimum(self._begin[hashes >> np.uint64(48)], last)
        for _ in range(np.diff(self._begin, append=last + 1).max() - 1):
            at = np.minimum(at + (self.hashes[at] < hashes), last)
        return at


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and length of every word, and the places where the texts' words begin."""
    data, offsets = flat_bytes(texts)
    begin, end, first = W.spans(data, offsets)
    return W.word_hashes(data, begin, end), end - begin, first


def around(tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The words at each offset of each word, or the end mark."""
    out = np.full((len(tokens), len(OFFSETS)), SIZE, np.int64)
    begin, end = first[:-1], first[1:]
    for k, o in enumerate(OFFSETS):
        to, of = (slice(-o, None), slice(o)) if o < 0 else (slice(-o), slice(o, None))
        out[to, k] = tokens[of]
        # The words at the edge of a text got some of the next text's.
        for i in range(abs(o)):
            at = begin + i if o < 0 else end - 1 - i
            out[at[(at >= begin) & (at < end)], k] = SIZE
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(h, n, spelt):
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64)), spelt], ["word", "n", "spelt"])

    def merged(held):
        hashes, counts, spelt = zip(*held)
        hashes, first, which = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        return hashes, np.bincount(which, np.concatenate(counts), len(hashes)), pa.concat_arrays(spelt).take(pa.array(first))

    def full(held):
        return sum(len(h) for h, _, _ in held) > HELD_WORDS or sum(x.nbytes for _, _, x in held) > HELD_BYTES

    none = np.zeros(0, np.uint64), np.zeros(0), pa.array([], pa.large_binary())
    held = [none]
    for batch in batches:
        for piece in slices(batch, 0):
            data, offsets = flat_bytes(piece.column(0))
            begin, end, _ = W.spans(data, offsets)
            h, first, n = np.unique(W.word_hashes(data, begin, end), return_index=True, return_counts=True)
            held.append((h, n, rare.cut_out(data, begin[first], end[first])))
            # Merged only when there may be too many: each piece repeats words of those before.
            if full(held):
                held = [merged(held)]
                if full(held):
                    h, n, spelt = held[0]
                    yield out(h, n, spelt.cast(pa.binary()))
                    held = [none]
    h, n, spelt = merged(held)
    yield out(h, n, spelt.cast(pa.binary()))


def build_vocabulary(docs: DataFrame, text: str = "text") -> Vocabulary:
    """The most frequent words over all documents, ties by hash, and the probabilities of all others."""
    ship(docs.sparkSession)
    counts = docs.select(text_of(text)).mapInArrow(_counted, "word long, n long, spelt binary")
    counts = freeze(counts.groupBy("word", "spelt").agg(F.sum("n").alias("n")), "words")
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).collect()
    hashes = np.array([r.word for r in top], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    last = (top[-1].n, top[-1].word) if len(top) == FREQUENT else (0, 0)
    others = counts.where((F.col("n") < last[0]) | ((F.col("n") == last[0]) & (F.col("word") > last[1])))
    return Vocabulary(hashes[order], order, rare.count(others, [bytes(r.spelt) for r in top]))


def _trained(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, start = sent.value
        network, seen = Network(start.copy()), 0
        step, slope = adam([network.flat], RATE), Network(np.zeros_like(start))
        for batch in batches:
            for piece in slices(batch, 0):
                h, lengths, first = _words(piece.column(0))
                tokens = vocabulary.tokens(h, lengths)
                context = around(tokens, first)
                for i in range(0, len(tokens), BATCH):
                    step([network.gradient(context[i : i + BATCH], tokens[i : i + BATCH], slope)])
                seen += len(tokens)
        if seen:
            flat = network.flat.astype(np.float64) * seen
            parts = [flat[i : i + PIECE].tobytes() for i in range(0, len(flat), PIECE)]
            group = TaskContext.get().partitionId() % GROUPS
            n = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, group, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, seen, np.int64)), pa.array(parts, pa.binary())],
                ["group", "piece", "n", "weights"],
            )

    return run


def _summed(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weights times words, added up row by row."""
    total, n = 0.0, 0
    for b in batches:
        for w, k in zip(b.column("weights"), b.column("n").to_pylist()):
            total, n = total + np.frombuffer(w.as_buffer(), np.float64), n + k
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([n], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["piece", "n", "weights"])


def train(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", rounds: int = 1) -> Network:
    """``rounds`` passes over all words of all documents; without words the first weights stay."""
    spark, network = docs.sparkSession, Network()
    ship(spark)
    kind = "piece int, n long, weights binary"
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast((replace(vocabulary, rare=None), network.flat))
        parts = docs.select(text_of(text)).mapInArrow(_trained(sent), "group int, " + kind)
        sums = parts.groupBy("piece", "group").applyInArrow(_summed, kind).groupBy("piece").applyInArrow(_summed, kind)
        rows = sorted(sums.collect(), key=lambda r: r.piece)
        if rows:
            network = Network(np.concatenate([np.frombuffer(r.weights, np.float64) / r.n for r in rows]))
    return network


def score(docs: DataFrame, vocabulary: Vocabulary, network: Network, text: str = "text", sent_words: int = SENT_WORDS) -> DataFrame:
    """All rows and columns with ``n_tokens``, ``log_likelihood``, ``mean_log_prob`` and ``pseudo_perplexity``.

    A text without words, also a null one, has no tokens, likelihood 0 and null for the other two.
    Repeated rows are scored alike. Columns called like the new ones are replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    own = vocabulary.rare.send(sent_words)
    sent = spark.sparkContext.broadcast((replace(vocabulary, rare=None), network.flat, own))
    kind = "n long, total double"
    if own is None:
        kind += ", others array<struct<word: long, times: long, spelt: binary>>"

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary, flat, own = sent.value
        network = Network(flat)
        for texts in batches:
            n, total, others = [np.zeros(0, np.int64)], [np.zeros(0)], [pa.array([], OTHERS)]
            for piece in slices(pa.RecordBatch.from_arrays([texts], ["t"]), 0):
                data, offsets = flat_bytes(piece.column(0))
                begin, end, first = W.spans(data, offsets)
                h = W.word_hashes(data, begin, end)
                tokens = vocabulary.tokens(h, end - begin)
                context = around(tokens, first)
                parts = [network.log_probabilities(context[i : i + 4 * BATCH], tokens[i : i + 4 * BATCH]) for i in range(0, len(tokens), 4 * BATCH)]
                log_p = np.concatenate([np.zeros(0), *parts])
                at = np.flatnonzero(tokens >= SIZE - LENGTHS)
                if own is None:
                    others.append(_others(at, data, begin, end, h, first))
                else:
                    log_p[at] += own.log_probabilities(h[at], data, begin[at], end[at])
                before = np.concatenate([[0.0], np.cumsum(log_p)])
                n.append(np.diff(first))
                total.append(np.diff(before[first]))
            fields = {"n": pa.array(np.concatenate(n)), "total": pa.array(np.concatenate(total))}
            if own is None:
                fields["others"] = pa.concat_arrays(others)
            yield pa.StructArray.from_arrays(list(fields.values()), list(fields))

    new = ("n_tokens", "log_likelihood", "mean_log_prob", "pseudo_perplexity")
    names = [c for c in docs.columns if c.lower() not in new]
    rows, found = docs.select(F.struct(*names).alias("_row"), text_of(text).alias("_text")), F.arrow_udf(run, kind)("_text").alias("_score")
    if own is not None:
        rows = rows.select("_row", found)
    else:
        # The number of a row is that of the written table, so it stays what it is.
        rows = freeze(rows.withColumn("_key", F.monotonically_increasing_id()), "rows")
        scored = freeze(rows.select("_key", found), "scored")
        each = vocabulary.rare.log_probabilities(scored.select("_key", F.explode("_score.others").alias("w")).select("_key", "w.*"))
        rest = each.groupBy("_key").agg(F.sum(F.col("times") * F.col("log_p")).alias("rest"))
        total = (F.col("_score.total") + F.coalesce("rest", F.lit(0.0))).alias("total")
        done = scored.join(rest, "_key", "left").select("_key", F.struct("_score.n", total).alias("_score"))
        rows = rows.drop("_text").join(freeze(done, "likelihoods"), "_key")
    n, total = F.col("_score.n"), F.col("_score.total")
    mean = F.when(n > 0, total / n)
    return rows.select("_row.*", n.alias("n_tokens"), total.alias("log_likelihood"), mean.alias("mean_log_prob"), F.exp(-mean).alias("pseudo_perplexity"))


OTHERS = pa.list_(pa.struct([("word", pa.int64()), ("times", pa.int64()), ("spelt", pa.binary())]))


def _others(at: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray, h: np.ndarray, first: np.ndarray) -> pa.Array:
    """For each text its different words among those ``at``, how often, and their bytes."""
    of = np.searchsorted(first, at, "right") - 1
    order = np.lexsort((h[at], of))
    at, of = at[order], of[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (of[1:] != of[:-1]) | (h[at[1:]] != h[at[:-1]])
    start = np.flatnonzero(fresh)
    at, of, times = at[start], of[start], np.diff(np.append(start, len(at)))
    spelt = rare.cut_out(data, begin[at], end[at]).cast(pa.binary())
    entries = pa.StructArray.from_arrays([pa.array(h[at].view(np.int64)), pa.array(times.astype(np.int64)), spelt], ["word", "times", "spelt"])
    places = np.searchsorted(of, np.arange(len(first)))
    return pa.ListArray.from_arrays(pa.array(places.astype(np.int32)), entries).cast(OTHERS)
