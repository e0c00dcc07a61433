import math
import random

import numpy as np
from sensorloom.llm import scoring


def test_probabilities_add_up_to_one():
    network = scoring.Network()
    context = np.array([[1, 2, scoring.SIZE, 40]] * scoring.SIZE)
    p = np.exp(network.log_probabilities(context, np.arange(scoring.SIZE)).astype(float))
    assert abs(p.sum() - 1) < 1e-4


def test_gradient():
    rng = np.random.default_rng(1)
    network = scoring.Network(scoring.Network().flat * 3)
    context, target = rng.integers(0, scoring.SIZE + 1, (40, 4)), rng.integers(0, scoring.SIZE, 40)
    loss = lambda flat: -scoring.Network(flat).log_probabilities(context, target).astype(float).mean()
    got = network.gradient(context, target)
    for k in np.argsort(-np.abs(got))[:200:20]:
        step = np.zeros_like(network.flat)
        step[k] = 0.05
        assert abs((loss(network.flat + step) - loss(network.flat - step)) / 0.1 - got[k]) < 2e-3 + 0.03 * abs(got[k])


def test_context_stays_in_its_document():
    got = scoring.around(np.array([5, 6, 7, 8]), np.array([0, 3, 3, 4]))
    end = scoring.SIZE
    assert got.tolist() == [[end, end, 6, 7], [end, 5, 7, end], [5, 6, end, end], [end] * 4]


def plain(vocabulary, network, text):
    """One word after the other."""
    words = (text or "").encode().split()
    h = [scoring.W.word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words]
    ids = [int(vocabulary.tokens(np.array([x]), np.array([len(w)]))[0]) for x, w in zip(h, words)]
    total = 0.0
    for i in range(len(ids)):
        near = [ids[i + o] if 0 <= i + o < len(ids) else scoring.SIZE for o in (-2, -1, 1, 2)]
        hidden = np.tanh(np.concatenate([network.embedding[j] for j in near]) @ network.context + network.hidden_bias)
        c, m = divmod(ids[i], 32)
        for z, k in ((hidden @ network.classes + network.class_bias, c), (hidden @ network.members[c] + network.member_bias[c], m)):
            total += float(z[k]) - math.log(np.exp(z.astype(float)).sum())
    return len(ids), total


def corpus():
    """Each word says which two come next."""
    rng, texts = random.Random(9), []
    for _ in range(300):
        k = rng.randrange(50)
        texts.append(" ".join(f"word{(k + i * 7) % 50}" for i in range(500)))
    return texts


def test_scores(documents):
    texts = [None, "", " \n", "one", "rare" * 20, "é ß  漢字\tx"] + corpus()
    docs = documents(texts)
    vocabulary = scoring.build_vocabulary(docs)
    assert len(vocabulary.hashes) == 50 + 6
    network = scoring.train(docs, vocabulary, rounds=5)
    rows = {r.doc_id: r for r in scoring.score(docs, vocabulary, network).collect()}
    assert len(rows) == len(texts)
    for i in (*range(6), 10, 200):
        n, total = plain(vocabulary, network, texts[i])
        assert rows[i].n_tokens == n and abs(rows[i].log_likelihood - total) < 1e-3 * (1 + abs(total))
    assert rows[0].mean_log_prob is None and rows[0].log_likelihood == 0
    # It has learned more than how frequent words are, and sees that a shuffled text is odd.
    trained = np.mean([rows[i].mean_log_prob for i in range(6, len(texts))])
    assert trained > -math.log(50) + 0.5
    words = texts[50].split()
    random.Random(1).shuffle(words)
    odd = scoring.score(documents([" ".join(words)]), vocabulary, network).first()
    assert odd.mean_log_prob < trained - 1


def test_rounds_and_empty(documents):
    docs = documents(corpus()[:60])
    vocabulary = scoring.build_vocabulary(docs)
    mean = lambda n: scoring.score(docs, vocabulary, scoring.train(docs, vocabulary, rounds=n)).agg({"mean_log_prob": "avg"}).first()[0]
    assert mean(3) > mean(1)
    none = documents([])
    vocabulary = scoring.build_vocabulary(none)
    assert scoring.score(none, vocabulary, scoring.train(none, vocabulary)).count() == 0


def test_rare_words_have_probabilities_of_their_own(documents, monkeypatch):
    """Rare words of one length add up to one with all other strings, and spelling and counts tell them apart."""
    monkeypatch.setattr(scoring, "FREQUENT", 4)
    rng = random.Random(3)
    real = ["ab" + "".join(rng.choices("aeiou", k=6)) for _ in range(40)]
    # The words of one length are 8 bytes long, those of another one byte.
    texts = ["the of and to " * 60 + " ".join(rng.choices(real, k=300)) + " often123 " * 9 + " x y y z " for _ in range(20)]
    docs = documents(texts)
    vocabulary = scoring.build_vocabulary(docs)
    assert len(vocabulary.hashes) == 4
    network = scoring.Network()
    asked = [real[0], "often123", "abaeiouu", "qzxjkwvp", "x" * 40, real[1] + " the " + real[1]]
    likelihoods = lambda n: [r.log_likelihood for r in sorted(scoring.score(documents(asked), vocabulary, network, sent_words=n).collect(), key=lambda r: r.doc_id)]
    got = likelihoods(scoring.SENT_WORDS)
    assert np.allclose(got, likelihoods(0), rtol=1e-5)
    assert all(math.isfinite(x) for x in got) and len(set(got)) == len(got)
    assert got[0] > got[2] > got[3] + 3 and got[1] > got[3]
    # One byte long: x, y, z and all other bytes that can be a word.
    every = [bytes([b]) for b in range(256) if not scoring.W.SPACE[b]]
    spark = docs.sparkSession
    h = [int(scoring.W.word_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([1])).view(np.int64)[0]) for w in every]
    table = spark.createDataFrame(list(zip(h, map(bytearray, every))), "word long, spelt binary")
    p = [math.exp(r.log_p) for r in vocabulary.rare.log_probabilities(table).collect()]
    assert len(p) == 250 and abs(sum(p) - 1) < 1e-6


def test_rare_words_are_counted_over_all_documents(documents):
    """Every word beyond the tokens is counted, however many there are."""
    words = [f"w{i:05}" for i in range(3000)]
    vocabulary = scoring.build_vocabulary(documents([" ".join(words[k::3] * 2) for k in range(3)]))
    assert vocabulary.rare.table.count() == 3000 - scoring.FREQUENT


def test_no_row_beyond_the_words_passes_a_softmax(monkeypatch):
    """Each word stands once among the classes and once among its class's members; filling rows are no part of that."""
    rng, rows, plain_softmax = np.random.default_rng(4), [], scoring._softmax
    context = rng.integers(0, scoring.SIZE + 1, (1000, 4))
    target = np.minimum(rng.zipf(1.3, 1000), scoring.SIZE) - 1
    monkeypatch.setattr(scoring, "_softmax", lambda z, *rest: rows.append(z.size // 32) or plain_softmax(z, *rest))
    scoring.Network().gradient(context, target)
    assert rows == [1000, 1000]


def test_words_are_found_by_their_hash():
    """Also when hashes begin alike."""
    rng = np.random.default_rng(5)
    for shift in (0, 8, 40):
        hashes = np.unique(rng.integers(0, 2**64, 300, np.uint64) >> np.uint64(shift))
        rank = rng.permutation(len(hashes))
        vocabulary = scoring.Vocabulary(hashes, rank)
        asked = np.concatenate([hashes, hashes + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
        known = dict(zip(hashes.tolist(), rank.tolist()))
        assert vocabulary.tokens(asked, np.full(len(asked), 7)).tolist() == [known.get(h, scoring.SIZE - 7) for h in asked.tolist()]


def test_edges_of_short_texts():
    lengths = [0, 1, 0, 0, 2, 3, 0, 5, 1, 0]
    texts = np.split(np.arange(sum(lengths)), np.cumsum(lengths)[:-1])
    got = scoring.around(np.arange(sum(lengths)), np.concatenate([[0], np.cumsum(lengths)]))
    assert got.tolist() == [[t[i + o] if 0 <= i + o < len(t) else scoring.SIZE for o in scoring.OFFSETS] for t in texts for i in range(len(t))]
