import math
import random

import pyarrow as pa
from sensorloom.llm import urls

CASES = [
    (None, "", "", None),
    ("no scheme/en", "", "", None),
    ("http://Example.ORG/es/1?x", "example.org", "/es/1", "example.org/es/"),
    ("http://example.org/en/12", "example.org", "/en/12", "example.org/en/1"),
    ("http://example.org/en/2", "example.org", "/en/2", "org/"),
    ("x://a.b.example.org/es/", "a.b.example.org", "/es/", "example.org/es/"),
    ("x://notexample.org/es/", "notexample.org", "/es/", "org/"),
    ("x://org", "org", "", None),
    ("x://org?/", "org", "", None),
    ("x://forg/", "forg", "/", None),
    ("x://a.com/fr/x#y", "a.com", "/fr/x", "com/fr/"),
    ("x://a.com/de/", "a.com", "/de/", "com/de/"),
    ("x://a.com/it/", "a.com", "/it/", None),
    ("x://É.Com:80/de/", "É.com:80", "/de/", None),
    ("x://a.com/fr/http://b.org/es/", "a.com", "/fr/http://b.org/es/", "com/fr/"),
    ("://", "", "", None),
    ("x://a.org\n.com/fr/", "a.org\n.com", "/fr/", "com/fr/"),
]


def pages(spark, cases):
    return spark.createDataFrame(list(enumerate(cases)), "page_id bigint, url string").repartition(3)


def plain_log(counted, text, model):
    """Smoothed variable-order probabilities from plain dictionaries."""
    total = 0.0
    data = text.encode() + b"\x03"
    for i in range(len(data)):
        p = 1 / 256
        for k in range(min(i, urls.ORDER) + 1):
            ctx = data[i - k : i]
            p = (counted[model].get((ctx, data[i]), 0) + urls.SMOOTHING * p) / (counted[model].get(ctx, 0) + urls.SMOOTHING)
        total += math.log(p)
    return total / len(data)


def count_plain(texts):
    out = ({}, {})
    for text, rejected in texts:
        data = text.encode() + b"\x03"
        for i in range(len(data)):
            for k in range(min(i, urls.ORDER) + 1):
                ctx = data[i - k : i]
                out[rejected][ctx] = out[rejected].get(ctx, 0) + 1
                out[rejected][(ctx, data[i])] = out[rejected].get((ctx, data[i]), 0) + 1
    return out


def test_rules(spark):
    rows = {r.page_id: r for r in urls.filter_urls(pages(spark, [c[0] for c in CASES])).collect()}
    verdicts = {rule: what for what, rule in urls.RULES}
    for i, (_, host, path, rule) in enumerate(CASES):
        assert (rows[i].host, rows[i].path, rows[i].rule) == (host, path, rule)
        assert rows[i].verdict == verdicts[rule] if rule else rows[i].verdict in ("allow", "block")


def test_models_like_dictionaries(spark):
    rng = random.Random(4)
    texts = [("".join(rng.choices("abc/", k=rng.randrange(12))), rng.random() < 0.4) for _ in range(300)] + [("", True), ("é", False)]
    count = urls.train(spark.createDataFrame(texts, "text string, rejected boolean").repartition(4))
    plain = count_plain(texts)
    asked = ["abc", "", "cab/cab", "zz", "é", texts[0][0]]
    got = urls.log_ratio(count, pa.array(asked))
    for t, g in zip(asked, got):
        want = plain_log(plain, t, 0) - plain_log(plain, t, 1) if t else 0.0
        assert abs(g - want) < 1e-3


def test_learns_from_the_rules(spark):
    rng = random.Random(5)
    good = lambda: "".join(rng.choices("aeiou", k=12))
    bad = lambda: "".join(rng.choices("xyzqw", k=12))
    cases = [f"http://{good()}.org/a" for _ in range(200)] + [f"http://{bad()}.com/de/" for _ in range(200)]
    cases += [f"http://{good()}.net/" for _ in range(40)] + [f"http://{bad()}.net/" for _ in range(40)]
    rows = sorted(urls.filter_urls(pages(spark, cases)).collect(), key=lambda r: r.page_id)
    assert [r.verdict for r in rows[400:]] == ["allow"] * 40 + ["block"] * 40


def test_threshold():
    assert urls.threshold_of([]) == 0.0
    assert urls.threshold_of([(5, False, 3)]) == 0.0
    assert 0 < urls.threshold_of([(10, False, 5), (-10, True, 5), (5, True, 1), (20, False, 9)]) <= 0.02


def test_empty_and_clashes(spark):
    assert urls.filter_urls(pages(spark, [])).count() == 0
    df = pages(spark, ["http://a.org/"]).selectExpr("page_id", "url", "'x' as Rule", "'y' as text")
    row = urls.filter_urls(df).first()
    assert row.rule == "org/" and row.text == "y"


def test_counts_are_by_key_however_many(spark):
    """Each n-gram has the count of its own, also where there are more than 2^20 of them."""
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_"
    texts = [("".join(rng.choices(letters, k=400)), i % 2 == 1) for i in range(1200)]
    counts = urls.train(spark.createDataFrame(texts, "text string, rejected boolean").repartition(4))
    plain = count_plain([(t, int(r)) for t, r in texts])
    assert len(counts.keys) == len(set(plain[0]) | set(plain[1])) > 1 << 20
    for t in ("".join(rng.choices(letters, k=60)), texts[0][0][:50], texts[1][0][:50], "/?"):
        want = plain_log(plain, t, 0) - plain_log(plain, t, 1)
        assert abs(urls.log_ratio(counts, pa.array([t]))[0] - want) < 1e-6
