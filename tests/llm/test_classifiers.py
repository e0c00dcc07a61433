import random

import numpy as np
import pyarrow as pa
import pytest
from sensorloom.llm import features, language, quality

WORDS = {
    "aa": "bala mako tira nuve solo pika dora".split(),
    "bb": "krst blvn zdrm plst vrch mlkn trpt".split(),
    "cc": "üöä ßeü äöß öüß ääü ßöö üßä".split(),
    "dd": "th'on wh'er sh'an th'is wh'at ch'op sh'el".split(),
    "ee": "xiqua quaxi zexiq iquax quexi xaqui qizex".split(),
    "ff": "ノート カメラ テスト ドラマ バナナ メロン ホテル".split(),
}


def text(rng, lang, n=None):
    return " ".join(rng.choices(WORDS[lang], k=n or rng.randrange(5, 60)))


@pytest.mark.parametrize("k", range(1, 12))
def test_codewords_differ(k):
    codes = language.codewords(k)
    assert codes.shape[0] == k and set(codes.ravel()) <= {1.0, -1.0}
    for i in range(k):
        for j in range(i):
            assert (codes[i] != codes[j]).sum() >= max(1, codes.shape[1] // 4)


def test_features_like_plain_counts():
    texts = ["Ab c", None, "", "é", "ab"]
    found = features.parts(pa.array(texts), (1, 2, 3), features.AS_IS, True)
    for bucket, begin, end in found[:3]:
        assert len(begin) == len(end) == 5 and (begin <= end).all()
    assert [list(e - b) for _, b, e in found] == [[4, 0, 0, 2, 2], [3, 0, 0, 1, 1], [2, 0, 0, 0, 0], [2, 0, 0, 1, 1], [1, 0, 0, 0, 0]]
    assert found[1][0][0] == found[1][0][found[1][1][4]]  # "ab" in both
    weights = np.random.default_rng(1).normal(size=(1 << features.BITS, 3))
    want = np.zeros((5, 3))
    for k in range(5):
        own = np.concatenate([b[i[k] : j[k]] for b, i, j in found])
        want[k] = weights[own].mean(axis=0) if len(own) else 0
    assert np.allclose(features.means(found, weights), want)
    for k, (at, share) in enumerate(features.histograms(found)):
        assert np.allclose(share @ weights[at], want[k], atol=1e-5)


def frame(documents, texts, langs):
    df = documents(texts)
    langs = df.sparkSession.createDataFrame(list(enumerate(langs)), "doc_id bigint, lang string")
    return df.drop("lang").join(langs, "doc_id")


def test_languages(documents):
    rng = random.Random(1)
    langs = [rng.choice(list(WORDS)) for _ in range(600)]
    texts = [text(rng, x) for x in langs]
    texts[:6], langs[:3] = [None, "", "12 34!", "x", "A", "..."], [None, None, "aa"]
    df = frame(documents, texts, langs)
    model = language.train(df, most=60)
    assert model.languages == sorted(WORDS)
    rows = {r.doc_id: r for r in language.identify(df, model).collect()}
    assert len(rows) == 600 and all(0 <= r.score <= 1 for r in rows.values())
    assert [rows[i].lang_pred for i in (0, 1, 2, 5)] == ["und"] * 4 and rows[0].score == 0 and rows[0].ambiguous
    assert np.mean([rows[i].lang_pred == langs[i] for i in range(6, 600)]) > 0.98
    again = {r.doc_id: r.lang_pred for r in language.identify(df.repartition(7), language.train(df.repartition(5), most=60)).collect()}
    assert again == {i: r.lang_pred for i, r in rows.items()}


def test_mixed_text_is_ambiguous(documents):
    rng = random.Random(2)
    langs = ["aa", "bb"] * 100
    df = frame(documents, [text(rng, x) for x in langs], langs)
    model = language.train(df)
    flagged = language.identify(documents([text(rng, "aa", 40), text(rng, "ff", 1)[:1]]), model).orderBy("doc_id").collect()
    assert not flagged[0].ambiguous and flagged[1].ambiguous


def test_degenerate_languages(documents):
    none = language.train(documents([None, "", "1"]))
    assert [r.lang_pred for r in language.identify(documents(["text"]), none).collect()] == ["und"]
    one = language.train(documents(["text", "more"]))
    assert [(r.lang_pred, r.score) for r in language.identify(documents(["other"]), one).collect()] == [("en", 1.0)]
    assert language.identify(documents([]), one).count() == 0
    df = documents(["text"]).withColumnsRenamed({"source": "found", "n_chars": "Score"})
    assert language.identify(df, one).first().found == "src0"


def test_quality(documents, spark):
    rng = random.Random(3)
    good = [text(rng, "aa") for _ in range(300)]
    bad = [text(rng, "aa").replace(" ", " ### ") if i % 2 else " ".join([f"w{i}x"] * 30) for i in range(100)]
    texts = good + bad + [None, ""]
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(400) if i % 4] + [(401, 1), (400, 1), (5, 7), (6, None)], "doc_id bigint, quality int")
    df = documents(texts)
    model = quality.train(df, labels)
    rows = {r.doc_id: r for r in quality.score(df, model).collect()}
    assert len(rows) == 402 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())
    assert np.mean([rows[i].predicted == int(i < 300) for i in range(0, 400, 4)]) > 0.95
    assert rows[400].score == rows[401].score
    nothing = quality.train(df, labels.limit(0))
    assert quality.score(documents([]), nothing).count() == 0
    assert all(0.2 < r.score < 0.8 for r in quality.score(documents([None]), nothing).collect())
