"""The pipeline against its stages by brute force, and the registered queries on the smallest tables."""

import os
import random
import zlib

import corpus_pipeline
import numpy as np
import pytest
from sensorloom.llm import queries

from .test_classifiers import WORDS
from .test_simhash import plain_components, plain_fingerprint
from .test_substring import plain as plain_repeats

tokenizers = pytest.importorskip("tokenizers")
TABLES = "/root/testdata/sf0.001"


def corpus():
    """(text, language): clean documents, copies, near copies, shared passages, and texts without letters."""
    rng = random.Random(12)
    clean = lambda lang, n: " ".join(rng.choices(WORDS[lang], k=n)) + " " + " ".join(f"{w}{rng.randrange(99)}" for w in rng.choices(WORDS[lang], k=n))
    rows = [(clean(lang, 60), lang) for lang in WORDS for _ in range(12)]
    rows += [rows[i] for i in (0, 0, 5, 30)]
    rows += [(rows[i][0] + " " + rows[i][0].split()[0], rows[i][1]) for i in (1, 13, 25)]
    passage = clean("aa", 40)
    rows += [(clean("aa", 20) + "\n" + passage + " " + clean("aa", 15), "aa") for _ in range(4)]
    rows += [(passage, "aa"), (None, None), ("", "aa"), ("12 34", "bb"), ("?!", None)]
    rng.shuffle(rows)
    return rows


def test_stages_by_brute_force(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    rows = [(i * 3, t, lang, f"src{i % 3}", None if t is None else len(t)) for i, (t, lang) in enumerate(corpus())]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {r[0]: r[1] for r in rows}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        got = docs.collect()
        if name == "language_id":
            want = {i: t for i, t in kept.items() if t and any(c.isalpha() for c in t)}
        elif name == "exact_dedup":
            last = {t: i for i, t in sorted(kept.items())}
            want = {i: t for t, i in last.items()}
        elif name == "near_dedup":
            ids = sorted(kept)
            label = plain_components([plain_fingerprint(kept[i]) for i in ids])
            want = {ids[k]: kept[ids[k]] for k in range(len(ids)) if label[k] == k}
            assert len(want) < len(kept)
        elif name == "substring_dedup":
            done = plain_repeats([kept[i] for i in sorted(kept)], sorted(kept))
            want = {i: text if gone else kept[i] for i, n, gone, text in done if gone < n or not n}
            assert any(gone for _, _, gone, _ in done)
        else:
            break
        assert {r.doc_id: r.text for r in got} == want and len(got) == len(want)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept = want
    library = tokenizers.Tokenizer.from_file(queries.vocabulary_path())
    ids = {i: library.encode(t, add_special_tokens=False).ids + [0] for i, t in kept.items()}
    assert sorted(r.doc_id for r in got) == sorted(kept)
    for r in got:
        assert (r.piece, r.start, r.length) == (0, 0, len(ids[r.doc_id]))
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id], "<u4").tobytes())
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 2048 and len(ends) <= -(-sum(map(len, ids.values())) // 2048) + 1


def test_empty_documents_pass(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.exists(f"{TABLES}/documents.parquet"), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{TABLES}/{t}.parquet')")
    got = queries.QUERIES[name](spark, TABLES).toPandas()
    want = con.execute(queries.ORACLES[name]).fetchdf()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    order = lambda df: sorted(map(repr, df[columns].astype(object).where(df[columns].notna(), None).values.tolist()))
    assert order(got) == order(want)


def test_near_copies_are_judged_by_row(spark, documents):
    """Null and repeated ids: clean rows stay, and of near copies one row stays."""
    rng = random.Random(21)
    clean = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(150))
    base, alike, other, lone = clean(), clean(), clean(), [clean() for _ in range(4)]
    tail = " tail"
    cases = [
        (1, base), (None, base + tail),  # one null id is a near copy
        (None, lone[0]), (None, lone[1]),  # the other null ids are clean
        (2, lone[2]), (7, lone[3]),
        (7, alike + tail), (4, alike),  # a near copy shares its id with a clean row
        (9, other), (9, other + tail),  # near copies that share an id
    ]
    nulls = clean()
    cases += [(None, nulls), (None, nulls + tail), (None, nulls)]
    prints = {t: plain_fingerprint(t) for _, t in cases}
    label = plain_components([prints[t] for _, t in cases])
    assert len(set(label)) == 8
    docs = documents([t for _, t in cases], [i for i, _ in cases])
    kept = corpus_pipeline.near(spark, docs, "")
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(got) == 8
    assert {(1, base), (None, lone[0]), (None, lone[1]), (2, lone[2]), (7, lone[3]), (4, alike)} <= set(got)
    first = lambda a, b: min((a, b), key=lambda t: int(np.uint64(prints[t]).astype(np.int64)))
    if prints[other] != prints[other + tail]:
        assert (9, first(other, other + tail)) in got
    assert sum(i == 9 for i, _ in got) == 1 and sum(i is None for i, _ in got) == 3
