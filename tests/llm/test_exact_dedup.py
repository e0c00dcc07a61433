import hashlib
import random

import numpy as np
import pytest
from sensorloom.llm import exact_dedup as ed


def plain(texts, ids):
    big = 2**63
    groups = {}
    for t, i in zip(texts, ids):
        groups.setdefault(t or "", []).append(big if i is None else i)
    out = []
    for t, own in groups.items():
        sha, keep = hashlib.sha256(t.encode()).hexdigest(), max(own)
        stays = True
        for i in sorted(own, reverse=True):
            out.append((None if i == big else i, None if keep == big else keep, len(own), i == keep and stays, sha))
            stays = False
    return sorted(out, key=repr)


def corpus():
    rng = random.Random(2)
    texts = [None, "", None, " ", "a", "a", "A", "a ", "é", "é", "x" * 100_000, "x" * 100_000]
    texts += ["hot copy"] * 300 + [f"text {rng.randrange(400)}" for _ in range(600)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("filter_bytes", [ed.FILTER_BYTES, 0])
def test_like_a_dictionary(documents, filter_bytes):
    texts = corpus()
    ids = random.Random(3).sample(range(-5000, 5000), len(texts))
    got = ed.exact_dedup(documents(texts, ids, parts=5), filter_bytes=filter_bytes).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=repr) == plain(texts, ids)
    assert {r.doc_id: r.text for r in got} == dict(zip(ids, texts))


def test_repeated_rows_and_null_ids(documents):
    texts, ids = ["a", "a", "a", "b", "b", "c", "c"], [4, 4, 1, None, 2, None, None]
    got = ed.exact_dedup(documents(texts, ids)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=repr) == plain(texts, ids)


def test_empty_and_clashing_columns(documents):
    assert ed.exact_dedup(documents([])).count() == 0
    df = documents(["t", "t"]).withColumnsRenamed({"lang": "kept", "source": "copy", "n_chars": "segment"})
    rows = ed.exact_dedup(df).collect()
    assert sorted(r.kept for r in rows) == [False, True] and {r.copy for r in rows} == {"src0"}


@pytest.mark.parametrize("filter_bytes", [ed.FILTER_BYTES, 0])
def test_own_names_and_maps_pass_through(documents, filter_bytes):
    df = documents(["t", "t", "u"]).withColumnsRenamed({"lang": "_hash", "source": "_n", "n_chars": "_salt"})
    df = df.selectExpr("*", "map(doc_id, 'x') as _keep", "'h' as _hot", "1 as _row")
    out = ed.exact_dedup(df, filter_bytes=filter_bytes)
    assert out.columns == [*df.columns, "keep_id", "group_size", "kept", "text_sha256"]
    got = {r.doc_id: (r._hash, r._n, r._salt, r._keep, r._hot, r._row, r.kept) for r in out.collect()}
    assert got == {i: ("en", "src0", 1, {i: "x"}, "h", 1, i > 0) for i in range(3)}


def test_one_of_many_copies_without_ids_stays(documents):
    texts = ["hot"] * 3000 + [f"t{i}" for i in range(3000)]
    out = ed.exact_dedup(documents(texts, [None] * 3000 + list(range(3000)), parts=6))
    rows = out.where("text = 'hot'").collect()
    assert sum(r.kept for r in rows) == 1 and {(r.keep_id, r.group_size) for r in rows} == {(None, 3000)}
    assert out.where("kept").count() == 3001


def test_no_repeat_is_missed():
    h = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    segment, at = ed.cells(np.concatenate([h, h[:500]]), 3)
    assert (segment[:500] == segment[5000:]).all() and all((a[:500] == a[5000:]).all() for a in at)
    assert len(np.unique(segment)) == 3
