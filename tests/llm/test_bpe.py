import random

import numpy as np
import pytest
from sensorloom.llm import bpe, queries

tokenizers = pytest.importorskip("tokenizers")
ALPHABET = "aaab \n\t  éß漢字😀'stlld123².,!\x1c\x1d\x85\xa0 ​٣Ⅷ½́ＡA\x00\r"


@pytest.fixture(scope="module")
def path():
    pytest.importorskip("public_tokenizers")
    return queries.vocabulary_path()


@pytest.fixture(scope="module")
def vocabulary(path):
    return bpe._read(path)


@pytest.fixture(scope="module")
def library(path):
    return tokenizers.Tokenizer.from_file(path)


def texts():
    rng = random.Random(1)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(3000)]
    out += ["a" * n for n in range(40)] + ["x" * 5000, "ab" * 3000, "é" * 3000, "=" * 9000, " " * 3000 + "x", "漢字" * 1500]
    out += ["".join(rng.choice("etaoinshr") for _ in range(20_000)), "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))]
    return out + ["", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext|"]


def test_like_the_library(vocabulary, library):
    own = texts()
    got = bpe.Encoder(vocabulary).encode(own)
    want = library.encode_batch(own, add_special_tokens=False)
    assert all(g.tolist() == w.ids for g, w in zip(got, want))
    for g, w in zip(got, want):
        decoder = bpe.Decoder(vocabulary)
        text = "".join(decoder.feed(g[k : k + 3]) for k in range(0, len(g), 3)) + decoder.feed(g[:0], True)
        assert text == library.decode(w.ids, skip_special_tokens=False)


@pytest.mark.parametrize("step, open_", [(1, 1), (2, 3), (7, 5), (64, 8), (1000, 100)])
def test_steps_of_any_size_like_the_library(vocabulary, library, monkeypatch, step, open_):
    monkeypatch.setattr(bpe, "STEP_CHARS", step)
    monkeypatch.setattr(bpe, "OPEN_CHARS", open_)
    rng = random.Random(step)
    own = ["".join(rng.choice("ab \n '1.re") * rng.randrange(1, 9) for _ in range(rng.randrange(30))) for _ in range(400)]
    own += [t[:3000] for t in texts()[2500:]]
    got = bpe.Encoder(vocabulary).encode(own)
    want = library.encode_batch(own, add_special_tokens=False)
    assert [g.tolist() for g in got] == [w.ids for w in want]


@pytest.mark.parametrize("text", [" " * 200_000 + "a", "\n" * 100_000 + "a", "ab" * 50_000, "=" * 100_000 + " 1", "1" * 100_000])
def test_long_runs_stream_and_hold_little(vocabulary, library, text):
    encoder, most, out = bpe.Encoder(vocabulary), 0, []
    for tokens, pieces in encoder.stream(text):
        most = max(most, sum(map(len, pieces)))
        encoder._learn(set(pieces))
        out += [tokens, *map(encoder.known.__getitem__, pieces)]
    assert np.frombuffer(b"".join(out), np.int32).tolist() == library.encode(text, add_special_tokens=False).ids
    assert most <= bpe.STEP_CHARS + bpe.OPEN_CHARS


def test_forgets_within_its_bound(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    encoder, own = bpe.Encoder(vocabulary), texts()[:200]
    for t in own:
        assert encoder.encode([t])[0].tolist() == library.encode(t, add_special_tokens=False).ids
        assert len(encoder.known) <= 50 + len(set(bpe.PIECES.findall(t)))


def test_decodes_broken_utf8_like_the_library(vocabulary, library):
    ids = random.Random(3).choices(range(vocabulary.size), k=2000)
    assert bpe.Decoder(vocabulary).feed(np.array(ids), True) == library.decode(ids, skip_special_tokens=False)


def test_stream_holds_little_and_equals_the_whole(vocabulary):
    rng = random.Random(2)
    data = "".join(rng.choice("etaoinshrdlucmf") for _ in range(30_000)).encode()
    stream, out, most = bpe.Transducer(vocabulary), [], 0
    for i in range(0, len(data), 700):
        out += list(stream.feed(data[i : i + 700]))
        most = max(most, len(stream.buffer))
    out.append(stream.finish())
    assert np.concatenate(out).tolist() == vocabulary.merge([data])[0].tolist()
    assert most <= stream.full + bpe.STEP_BYTES


def test_lookahead_bounds_every_change():
    """Random merge lists: a boundary further than the lookahead from the end never changes with what follows."""
    rng = random.Random(8)
    for _ in range(60):
        parts, merges = [b"a", b"b", b"c"], []
        for _ in range(rng.randrange(1, 12)):
            left, right = rng.choice(parts), rng.choice(parts)
            if left + right not in parts:
                merges.append((left, right))
                parts.append(left + right)
        reach = bpe.sufficient_lookahead(merges)

        def tokens(data):
            out = [data[i : i + 1] for i in range(len(data))]
            for pair in merges:
                i = 0
                while i < len(out) - 1:
                    if (out[i], out[i + 1]) == pair:
                        out[i : i + 2] = [out[i] + out[i + 1]]
                    i += 1
            return out

        def ends(data):
            return set(np.cumsum([len(t) for t in tokens(data)]).tolist())

        for _ in range(60):
            data = bytes(rng.choices(b"abc", k=rng.randrange(2, 40)))
            more = data + bytes(rng.choices(b"abc", k=rng.randrange(1, 12)))
            sure = len(data) - reach
            assert {e for e in ends(data) if e < sure} == {e for e in ends(more) if e < sure}


def test_tables(documents, path, library):
    own = [None, "", "plain text", "<|endoftext|>x", "😀é", "a b  c\n\n d" * 2000]
    docs = documents(own)
    sent = bpe.send_vocabulary(docs.sparkSession, path)
    rows = bpe.decode(bpe.encode(docs, sent), sent).collect()
    for r in rows:
        assert r.ids == library.encode(own[r.doc_id] or "", add_special_tokens=False).ids and r.decoded == (own[r.doc_id] or "")
    assert len(rows) == len(own)
    assert bpe.decode(bpe.encode(documents([]), sent), sent).count() == 0
    nulls = docs.sparkSession.createDataFrame([(None,), ([],), ([-1, 10**6, 64],)], "ids array<int>")
    assert sorted(r.decoded for r in bpe.decode(nulls, sent).collect()) == ["", "", "a"]
