"""Byte-pair encoding as a streaming transducer with bounded lookahead, and incremental decoding.

The merge list itself says how far the end of a text can reach back: ``sufficient_lookahead``. A
boundary between tokens that lies further from the end of what has been read is final, so the
transducer emits the tokens before it and keeps a buffer of constant size, however long the text is.
A text is read in steps: its closed pieces are stable, an open one is carried on, and one that stays open is
merged as it comes. Merging runs over many pieces in lock-step: in each round every piece applies its best-ranked merge
wherever it occurs. Pieces (words, numbers, runs of signs) are what the tokenizer's pattern splits.

Decoding maps tokens to bytes and bytes to text with a decoder that keeps the bytes of an unfinished
character between chunks; bytes that are no UTF-8 become U+FFFD.
"""

import codecs
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.common import release, slices, text_of
from sensorloom.session import ship

# How the tokenizer splits a text into pieces (fixed values of the vocabulary's format).
WHITE = r"\t-\r \x85\xa0  -     　"
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
WHITE_RUN = regex.compile(rf"[{WHITE}]*")
#: What a piece can go on with, by its last character.
RUNS = (regex.compile(r"\p{L}*"), regex.compile(r"\p{N}*"), WHITE_RUN, regex.compile(rf"[^{WHITE}\p{{L}}\p{{N}}]*"))
#: Characters after a piece that settle where it ends: the rest of a contraction.
DECIDING_CHARS = 3
#: A text is read in steps of so many characters; a piece that stays open longer than that is merged as it comes.
STEP_CHARS = 1 << 14
OPEN_CHARS = 1 << 10
#: Tokens are emitted from a buffer of so many bytes beside the lookahead.
STEP_BYTES = 512
#: Pieces that a task remembers, at most.
REMEMBERED = 200_000
REMEMBERED_CHARS = 1 << 23
#: Decoded at a time.
CHUNK_TOKENS = 1 << 16


def alphabet() -> dict[str, int]:
    """The characters that stand for bytes in vocabulary files: printable ones for themselves, the rest from 256 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in printable]
    return {**{chr(b): b for b in printable}, **{chr(256 + i): b for i, b in enumerate(others)}}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after a token boundary that decide whether it stands; what follows further on cannot.

    A merge at rank r removes the boundary between its halves. It may turn out differently only if a
    boundary up to the end of its right half does, which either is the end of what was read or was
    decided by a merge of a lower rank there. So a doubt travels left in steps of at most one right
    half, over ranks that rise; the longest such way bounds it. Two merges follow each other on a way
    only if their bytes agree next to the boundary; two bytes on each side are compared here, which
    can only make the bound larger than needed.
    """
    reach: dict[tuple, int] = {}
    longest = 0
    for left, right in merges:
        token, middle, far = left + right, len(left), len(right)
        for step in range(1, len(right) + 1):
            at = middle + step
            after = token[at : at + 2]
            ends = [after] if len(after) < 2 else [after, (after[:1],)]
            for before in (token[at - 2 : at], (token[at - 1 : at],)):
                for end in ends:
                    far = max(far, step + reach.get((before, end), 0))
        longest = max(longest, far)
        before = left[-2:] if len(left) > 1 else (left,)
        for end in (b"", right[:1], right[:2] if len(right) > 1 else (right,)):
            if reach.get((before, end), 0) < far:
                reach[before, end] = far
    return longest


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level vocabulary file; small enough to be sent to every task."""

    EMPTY = -1

    def __init__(self, definition: str):
        read = json.loads(definition)
        model, chars = read["model"], alphabet()
        as_bytes = lambda t: bytes(chars[c] for c in t)
        self.special = {t["content"]: t["id"] for t in read.get("added_tokens") or []}
        tokens = {t: i for t, i in model["vocab"].items() if t not in self.special}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        size = max([*tokens.values(), *self.special.values(), 0]) + 1
        by_id = [b""] * size
        for t, i in tokens.items():
            by_id[i] = as_bytes(t)
        for t, i in self.special.items():
            by_id[i] = t.encode()
        self.size, self.bytes_of = size, by_id
        self.first = np.zeros(256, np.int32)
        for c, b in chars.items():
            self.first[b] = tokens[c]
        self.ends = np.cumsum([len(b) for b in by_id])
        self.lengths = np.diff(self.ends, prepend=0)
        self.blob = np.frombuffer(b"".join(by_id), np.uint8)
        self.lookahead = sufficient_lookahead([(as_bytes(a), as_bytes(b)) for a, b in merges])
        # Merges by pair of tokens, in an open hash table.
        self.shift = 64 - max(4, (4 * len(merges)).bit_length())
        self.keys = np.full((1 << (64 - self.shift)) + 64, self.EMPTY, np.int64)
        self.rank = np.full(len(self.keys), len(merges), np.int32)
        self.made = np.zeros(len(self.keys), np.int32)
        self.none = len(merges)
        for r, (a, b) in enumerate(merges):
            key = tokens[a] * size + tokens[b]
            at = (key * 0x9E3779B97F4A7C15 & (2**64 - 1)) >> self.shift
            while self.keys[at] not in (self.EMPTY, key):
                at += 1
            if self.keys[at] == self.EMPTY:
                self.keys[at], self.rank[at], self.made[at] = key, r, tokens[a + b]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair in the table, or of an empty place, whose rank is ``none``."""
        key = left.astype(np.int64) * self.size + right
        at = ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(self.shift)).astype(np.int64)
        open_ = np.flatnonzero((self.keys[at] != key) & (self.keys[at] != self.EMPTY))
        while len(open_):
            at[open_] += 1
            found = self.keys[at[open_]]
            open_ = open_[(found != key[open_]) & (found != self.EMPTY)]
        return at

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Tokens of each piece."""
        data = np.frombuffer(b"".join(pieces), np.uint8)
        tokens = self.first[data]
        piece = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        done_tokens, done_piece, done_place = [], [], []
        place = np.arange(len(tokens))
        while len(tokens):
            together = piece[:-1] == piece[1:]
            at = self.look_up(tokens[:-1], tokens[1:])
            rank = np.where(together, self.rank[at], self.none)
            rank = np.append(rank, self.none)
            starts = np.flatnonzero(np.append(True, ~together))
            best = np.minimum.reduceat(rank, starts)
            alive = best < self.none
            best_here = np.repeat(best, np.diff(np.append(starts, len(tokens))))
            chosen = (rank == best_here) & (rank < self.none)
            # In a run of overlapping pairs every second one merges, from the left.
            where = np.flatnonzero(chosen)
            if len(where):
                new_run = np.append(True, np.diff(where) > 1)
                run_start = where[new_run][np.cumsum(new_run) - 1]
                where = where[(where - run_start) % 2 == 0]
                tokens = tokens.copy()
                tokens[where] = self.made[at[where]]
            keep = np.ones(len(tokens), bool)
            keep[where + 1] = False
            live = np.repeat(alive, np.diff(np.append(starts, len(tokens))))
            out = ~live
            done_tokens.append(tokens[out])
            done_piece.append(piece[out])
            done_place.append(place[out])
            keep &= live
            tokens, piece, place = tokens[keep], piece[keep], place[keep]
        if not done_tokens:
            return [np.zeros(0, np.int32) for _ in pieces]
        tokens, piece, place = np.concatenate(done_tokens), np.concatenate(done_piece), np.concatenate(done_place)
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(piece[order], np.arange(1, len(pieces)))
        return np.split(tokens[order], cuts)


class Transducer:
    """Bytes of one piece in, final tokens out; holds ``lookahead`` + ``STEP_BYTES`` + one token at most."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.buffer = vocabulary, b""
        self.full = STEP_BYTES + vocabulary.lookahead + 1 + int(vocabulary.lengths.max(initial=1))

    def feed(self, data: bytes) -> Iterator[np.ndarray]:
        for i in range(0, len(data), STEP_BYTES):
            self.buffer += data[i : i + STEP_BYTES]
            if len(self.buffer) >= self.full:
                tokens = self.vocabulary.merge([self.buffer])[0]
                ends = np.cumsum(self.vocabulary.lengths[tokens])
                n = int(np.searchsorted(ends, len(self.buffer) - self.vocabulary.lookahead, "left"))
                if n:
                    yield tokens[:n]
                    self.buffer = self.buffer[ends[n - 1] :]

    def finish(self) -> np.ndarray:
        last, self.buffer = self.buffer, b""
        return self.vocabulary.merge([last])[0] if last else np.zeros(0, np.int32)


class Encoder:
    """Texts to tokens, a step of each at a time: closed pieces are final, a long open one goes through a ``Transducer``.

    Texts advance side by side, so that the new pieces of all their steps merge in one lock-step pass.
    Beside the tokens, a text holds one step, an open piece of less than ``OPEN_CHARS`` characters, or the
    buffer of its transducer. Tokens of pieces are remembered within a bound.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.known, self.held = vocabulary, {}, 0
        self.special = regex.compile("|".join(regex.escape(s) for s in sorted(vocabulary.special, key=len, reverse=True))) if vocabulary.special else None

    def stream(self, text: str) -> Iterator[tuple[bytes, list[str]]]:
        """Steps of a text: final tokens of a long piece, and the pieces that are closed after it.

        A special token in the text is a piece of its own, which no other piece can equal.
        """
        at = 0
        if self.special is not None and any(s in text for s in self.vocabulary.special):
            for found in self.special.finditer(text):
                yield from self._plain(text, at, found.start())
                yield b"", [found.group()]
                at = found.end()
        yield from self._plain(text, at, len(text))

    def _plain(self, text: str, at: int, end: int) -> Iterator[tuple[bytes, list[str]]]:
        tail, run, tokens = "", None, b""
        while at < end:
            step = min(end, at + STEP_CHARS)
            buffer, last, at = tail + text[at:step], step == end, step
            if run is not None:
                stop = run.match(buffer).end()
                if stop == len(buffer) and not last:
                    # White space leaves its last character to what follows, so one is held back.
                    yield tokens + _packed(inner.feed(buffer[:-1].encode())), []
                    tail, tokens = buffer[-1:], b""
                    continue
                if stop < len(buffer) and run is WHITE_RUN:
                    stop -= 1
                tokens += _packed(inner.feed(buffer[:stop].encode())) + inner.finish().astype(np.int32).tobytes()
                buffer, run = buffer[stop:], None
            pieces, tail = PIECES.findall(buffer), ""
            while pieces and not last and len(tail) < DECIDING_CHARS:
                tail = pieces.pop() + tail
            yield tokens, pieces
            tokens = b""
            if len(tail) >= max(OPEN_CHARS, DECIDING_CHARS) and PIECES.match(tail).end() == len(tail):
                run = next(r for r in RUNS if r.match(tail[-1]).end())
                inner = Transducer(self.vocabulary)
                tokens, tail = _packed(inner.feed(tail[:-1].encode())), tail[-1:]

    def _learn(self, pieces: set[str]) -> None:
        """Remember the tokens of ``pieces``, whatever else is forgotten."""
        new = pieces - self.known.keys()
        if len(self.known) + len(new) > REMEMBERED or self.held > REMEMBERED_CHARS:
            self.known.clear()
            new, self.held = pieces, 0
        self.held += sum(map(len, new))
        short, whole = [], Transducer(self.vocabulary).full
        for p in new:
            if p in self.vocabulary.special:
                self.known[p] = np.array([self.vocabulary.special[p]], np.int32).tobytes()
                continue
            data = p.encode()
            if len(data) < whole:
                short.append((p, data))
            else:
                stream = Transducer(self.vocabulary)
                self.known[p] = _packed(stream.feed(data)) + stream.finish().astype(np.int32).tobytes()
        for i in range(0, len(short), 20_000):
            part = short[i : i + 20_000]
            for (p, _), tokens in zip(part, self.vocabulary.merge([d for _, d in part])):
                self.known[p] = tokens.astype(np.int32).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        streams = [self.stream(t) for t in texts]
        out: list[list[bytes]] = [[] for _ in texts]
        running = range(len(texts))
        while running:
            steps = [(i, step) for i in running if (step := next(streams[i], None)) is not None]
            self._learn(set().union(*(pieces for _, (_, pieces) in steps)))
            for i, (tokens, pieces) in steps:
                out[i].append(tokens)
                out[i].append(b"".join(map(self.known.__getitem__, pieces)))
            running = [i for i, _ in steps]
        return [np.frombuffer(b"".join(parts), np.int32) for parts in out]


def _packed(tokens: Iterator[np.ndarray]) -> bytes:
    return b"".join(t.astype(np.int32).tobytes() for t in tokens)


class Decoder:
    """Tokens in, text out, in chunks of any size; unknown ids give nothing."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, tokens: np.ndarray, last: bool = False) -> str:
        tokens = tokens[(tokens >= 0) & (tokens < self.vocabulary.size)]
        n = self.vocabulary.lengths[tokens]
        before = np.cumsum(n) - n
        at = np.arange(int(n.sum())) + np.repeat(self.vocabulary.ends[tokens] - n - before, n)
        return self.state.decode(self.vocabulary.blob[at].tobytes(), last)


@lru_cache(4)
def _read(path: str) -> Vocabulary:
    with open(path, encoding="utf-8") as f:
        return Vocabulary(f.read())


def send_vocabulary(spark: SparkSession, path: str):
    """The vocabulary in ``path`` (a file of the driver) as a broadcast of a few MB."""
    ship(spark)
    return spark.sparkContext.broadcast(_read(path))


def encode(docs: DataFrame, sent, text: str = "text", to: str = "ids") -> DataFrame:
    """Add the token ids of each whole text as ``to`` (array of int); a null text counts as empty and has none.

    All other columns stay; one called ``to`` is replaced. Rows do not meet, so repeated rows and null ids
    change nothing, and an empty table gives an empty one. A text may be as long as a value can be.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(sent.value)
        for texts in batches:
            ids, n = [np.zeros(0, np.int32)], [0]
            for part in slices(pa.RecordBatch.from_arrays([texts], ["t"]), 0):
                for tokens in encoder.encode(part.column(0).to_pylist()):
                    ids.append(tokens)
                    n.append(len(tokens))
            yield pa.ListArray.from_arrays(pa.array(np.cumsum(n), pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
        del encoder
        release()

    return docs.withColumn(to, F.arrow_udf(run, "array<int>")(text_of(text)))


def decode(df: DataFrame, sent, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """Add the text of an array of token ids as ``to``; null or empty arrays give the empty text.

    All other columns stay; one called ``to`` is replaced. An empty table gives an empty one.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            tokens, places = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
            out = []
            for i, j in zip(places, places[1:]):
                decoder, text = Decoder(sent.value), []
                for k in range(i, j, CHUNK_TOKENS):
                    text.append(decoder.feed(tokens[k : min(j, k + CHUNK_TOKENS)]))
                out.append("".join(text) + decoder.feed(tokens[:0], True))
            yield pa.array(out, pa.string())
        release()

    return df.withColumn(to, F.arrow_udf(run, "string")(F.coalesce(F.col(ids), F.array().cast("array<int>"))))
