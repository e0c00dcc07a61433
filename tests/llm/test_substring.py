import random
import re

from sensorloom.llm import substring


def plain(texts, ids, window=50):
    """Kept words of each row by a dictionary of all windows."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    least = {}
    for i, w in zip(ids, words):
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, w in zip(ids, words):
        gone = set()
        for s in range(len(w) - window + 1):
            if least[tuple(w[s : s + window])] < i:
                gone.update(range(s, s + window))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def corpus():
    rng = random.Random(3)
    fresh = lambda n: " ".join("w%d" % rng.randrange(10**6) for _ in range(n))
    shared = [fresh(n) for n in (49, 50, 51, 75, 130)]
    texts = [None, "", " \t\n", "short text", "a " * 300, "a " * 120, "é\xa0ß " * 60, "é\xa0ß " * 90]
    for s in shared:
        for _ in range(4):
            texts.append(" ".join([fresh(rng.randrange(40)), s.replace(" ", rng.choice([" ", "\n", "\t  "])), fresh(rng.randrange(40))]))
    whole = fresh(400)
    texts += [whole, whole, fresh(30) + " " + whole, " ".join(whole.split()[100:260]), fresh(20) + " " + shared[4] + " " + shared[3] + " " + shared[4]]
    texts += [fresh(rng.randrange(200)) for _ in range(10)]
    rng.shuffle(texts)
    return texts


def check(documents, texts, ids):
    got = substring.remove_repeats(documents(texts, ids)).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == sorted(plain(texts, ids))
    for r in got:
        assert sum(s.end - s.begin for s in r.removed_spans) == r.n_removed


def test_like_a_dictionary_of_windows(documents, monkeypatch):
    texts = corpus()
    ids = random.Random(4).sample(range(-1000, 1000), len(texts))
    check(documents, texts, ids)
    # The same over many batches and owners.
    monkeypatch.setattr(substring, "BATCH_BYTES", 3000)
    monkeypatch.setattr(substring, "OWNER_BYTES", 4000)
    check(documents, texts, ids)


def test_repeated_rows_and_null_ids(documents):
    text = " ".join(f"w{i}" for i in range(60))
    rows = substring.remove_repeats(documents([text] * 4, [3, 3, None, None])).collect()
    assert sorted(((r.doc_id is None), r.n_removed) for r in rows) == [(False, 0), (False, 0), (True, 60), (True, 60)]
    empty = substring.remove_repeats(documents([]))
    assert empty.count() == 0 and "kept_text" in empty.columns


def test_own_columns_pass(documents):
    df = documents(["some words"]).withColumnsRenamed({"lang": "n_words", "source": "batch", "n_chars": "_id"})
    row = substring.remove_repeats(df).first()
    assert row.n_words == 2 and row.kept_text == "some words" and row.batch == "src0" and row._id == 10
