import random

import numpy as np
import xxhash
from sensorloom.llm import simhash
from sensorloom.llm.components import connected_components


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(fps):
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i in range(len(fps)):
            for j in range(len(fps)):
                if (fps[i] ^ fps[j]).bit_count() <= 4 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def near(rng, fp, bits):
    for b in rng.sample(range(64), bits):
        fp ^= 1 << b
    return fp


TEXTS = [None, "", " \n", "one", "One two\tthree", "a b c d", "A  b\nc D e", "é É ß a\x0bb\x0cc", "x " * 500, "nbsp stays one word"]


def test_fingerprint():
    for t in TEXTS:
        assert simhash.fingerprint((t or "").encode()) == plain_fingerprint(t)


def test_near_pairs_finds_every_pair():
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(700)]
    fps = np.array(base + [near(rng, f, rng.randint(1, 6)) for f in base], np.uint64)
    got = {(int(x), int(y)) for a, b in simhash.near_pairs(fps, fps) for x, y in zip(a, b)}
    d = np.bitwise_count(fps[:, None] ^ fps[None, :])
    assert got == set(zip(*(a.tolist() for a in np.nonzero(d <= 4))))


def test_pairs_meet_in_a_shard():
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(400)]
    fps = np.array(base + [near(rng, f, rng.randint(1, 4)) for f in base], np.uint64)
    tree = simhash.build_tree(fps, 4)
    home, there = {}, {}
    for shard, at, is_home in simhash.route(tree, fps):
        for i in at.tolist():
            if is_home:
                home[i] = shard
            there.setdefault(i, set()).add(shard)
    assert len(home) == len(fps) and len(set(home.values())) > 8
    for i in range(400):
        j = i + 400
        assert home[i] in there[j] or home[j] in there[i]


def test_components_of_a_long_chain(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (100, 102), (7, 7)]
    got = dict(connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_near_duplicates(documents):
    rng = random.Random(7)
    words = ["w%d" % i for i in range(60)]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(12)]
    texts = TEXTS + base + [b.replace(" ", "  ", 3) for b in base[:5]] + [b + " tail" for b in base] + ["x " * 500]
    ids = [1000 - i for i in range(len(texts))]
    fps = [plain_fingerprint(t) for t in texts]
    label = plain_components(fps)
    want = {ids[i]: (fps[i], min(ids[j] for j in range(len(ids)) if label[j] == label[i])) for i in range(len(ids))}
    for shard_rows in (4, 1 << 15):
        rows = simhash.near_duplicates(documents(texts, ids), shard_rows=shard_rows).collect()
        assert {r.doc_id: (r.fp % 2**64, r.component_id) for r in rows} == want
        assert len(rows) == len(texts)
    assert simhash.near_duplicates(documents([])).count() == 0


def test_null_and_equal_ids(documents):
    rows = simhash.near_duplicates(documents(["a b c d e", "a b c d e", "other words are here now", "other words are here now"], [None, 5, None, None])).collect()
    assert sorted((r.doc_id is None, r.component_id) for r in rows if r.component_id) == [(False, 5), (True, 5)]
    assert [r.component_id for r in rows].count(None) == 2
