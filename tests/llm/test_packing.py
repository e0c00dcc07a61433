import random
import zlib
from itertools import combinations_with_replacement

import numpy as np
import pytest
from sensorloom.llm import packing, queries

tokenizers = pytest.importorskip("tokenizers")


def fills(count, capacity):
    """Number of sequences of a plan, after checking that it uses each rank once and overlaps nothing."""
    made = packing.plan(count, capacity)
    places = {}
    for length in range(1, capacity + 1):
        if not count[length]:
            continue
        first, base, offset = made[length]
        for rank in range(int(count[length])):
            k = int(np.searchsorted(first, rank, "right")) - 1
            places.setdefault(int(base[k] + rank - first[k]), []).append((int(offset[k]), length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(places) == list(range(len(places)))
    return len(places)


def test_plans():
    rng = np.random.default_rng(4)
    for capacity in (1, 2, 7, 40):
        for _ in range(40):
            lengths = rng.integers(1, capacity + 1, rng.integers(0, 60))
            count = np.bincount(lengths, minlength=capacity + 1)
            n = fills(count, capacity)
            assert -(-lengths.sum() // capacity) <= n <= -(-lengths.sum() // capacity) * 3 // 2 + 1


def test_exact_complements_leave_no_fitting_combination():
    rng = np.random.default_rng(6)
    for _ in range(30):
        count = np.bincount(rng.integers(1, 31, 50), minlength=31)
        before = count.copy()
        full = packing.exact_complements(count, 30)
        used = np.zeros(31, int)
        for pattern, n in full:
            assert sum(pattern) == 30 and len(pattern) <= 4
            for x in pattern:
                used[x] += n
        assert (used + count == before).all()
        left = [x for x in range(1, 31) for _ in range(min(4, count[x]))]
        present = set(left)
        for k in (1, 2, 3, 4):
            for combo in combinations_with_replacement(sorted(present), k):
                if sum(combo) == 30:
                    assert any(combo.count(x) > count[x] for x in combo)


def check(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by)


def test_documents(documents):
    pytest.importorskip("public_tokenizers")
    path = queries.vocabulary_path()
    library = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(3)
    texts = [None, "", "", "one", "<|endoftext|>", "word " * 63, "word " * 64, "word " * 129, "hot copy"] + ["hot copy"] * 200
    texts += [" ".join(rng.choices(["alpha", "beta", "gamma"], k=rng.randrange(150))) for _ in range(60)]
    docs = documents(texts)
    sent = packing.send_definition(docs.sparkSession, path)
    rows = packing.pack_documents(docs, sent, capacity=64, with_ids=True).collect()
    total = 0
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        total += len(ids)
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [x for r in own for x in r.ids] == ids
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
        assert all(r.length == 64 for r in own[1:]) and own[0].length <= 64
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in own)
    assert check(rows, 64) <= -(-total // 64) + 1


def test_lengths_that_fit_nowhere(spark):
    df = spark.createDataFrame([(1, 5, "x"), (2, None, "x"), (3, 0, "x"), (4, 11, "x"), (5, 5, "x")], "id int, length int, offset string")
    rows = {r.id: r for r in packing.pack(df, capacity=10).collect()}
    assert {rows[1].offset, rows[5].offset} == {0, 5} and rows[1].sequence_id == rows[5].sequence_id
    assert all(rows[i].sequence_id is None and rows[i].offset is None for i in (2, 3, 4))
    assert packing.pack(df.limit(0), capacity=10).count() == 0


@pytest.mark.parametrize("text", [" " * 1_000_000 + "a", "\n" * 1_000_000 + "a", "b" + "\t " * 500_000 + "c d"])
def test_very_long_runs_of_blanks(documents, text):
    path = queries.vocabulary_path()
    want = tokenizers.Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    docs = documents([text, "x y"])
    pieces = packing.pieces_of(docs, packing.send_definition(docs.sparkSession, path), with_ids=True)
    rows = pieces.where("doc_id = 0").orderBy("piece").collect()
    assert [i for r in rows for i in r.ids] == [*want, 0]
    assert packing.pack(pieces).where("sequence_id is null").count() == 0
