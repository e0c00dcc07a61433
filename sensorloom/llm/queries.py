"""Registered queries of this subpackage and, where SQL can express them, their SQL twins."""

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import bpe, language, quality, scoring, warc
from sensorloom.llm.clustering import cluster
from sensorloom.llm.codes import compress
from sensorloom.llm.common import table
from sensorloom.llm.exact_dedup import exact_dedup
from sensorloom.llm.neighbours import nearest
from sensorloom.llm.packing import pack_documents, send_definition
from sensorloom.llm.simhash import hex_of, near_duplicates
from sensorloom.llm.substring import remove_repeats
from sensorloom.llm.urls import filter_urls
from sensorloom.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _remainder(id: str, of: int) -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % of, F.lit(-1))


def vocabulary_path() -> str:
    """Where the public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = scoring.build_vocabulary(docs)
    scored = scoring.score(docs, vocabulary, scoring.train(docs, vocabulary))
    return scored.select("doc_id", "n_tokens", "log_likelihood", "mean_log_prob", "pseudo_perplexity")


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op2_exact_dedup"] = """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))
"""


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", hex_of().alias("fingerprint"), "component_id")


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.train(docs, labels.where(_remainder("doc_id", 5) != 0))
    return quality.score(docs, model).select("doc_id", (_remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def language_model(docs: DataFrame) -> language.LanguageModel:
    """Learned from the two thirds of documents that are not held out."""
    return language.train(docs.where(_remainder("doc_id", 3) != 1))


@query
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", (_remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "ambiguous")


ORACLES["op5_substring_dedup"] = r"""
with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
words as (select doc_id, unnest(ws) as word, unnest(range(len(ws))) as pos from docs),
runs as (
  select *, md5(string_agg(word, ' ') over w) as run, count(*) over w as n
  from words window w as (partition by doc_id order by pos rows between current row and 49 following)),
least as (select run, min(doc_id) as first_id from runs where n = 50 group by run),
hits as (select r.*, coalesce(n = 50 and first_id < doc_id, false) as hit from runs r left join least using (run)),
covered as (
  select *, bool_or(hit) over (partition by doc_id order by pos rows between 49 preceding and current row) as gone from hits),
kept as (
  select doc_id, count(*) filter (gone) as n_removed, coalesce(string_agg(word, ' ' order by pos) filter (not gone), '') as kept
  from covered group by doc_id)
select d.doc_id, len(ws)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from docs d left join kept using (doc_id)
"""


@query
def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sent = bpe.send_vocabulary(spark, vocabulary_path())
    coded = bpe.decode(bpe.encode(docs, sent), sent)
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = pack_documents(docs, send_definition(spark, vocabulary_path()))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 100 == 0, 10)


@query
def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), k=16, rounds=3, scale=64, width=64, seed="1").rows


@query
def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), parts=8, entries=16, rounds=6, scale=4096).rows


USABLE = "embedding is not null and len(embedding) = len(list_filter(embedding, lambda x: x is not null and isfinite(x)))"
#: Exact as long as the products stay below 2^53.
SQUARED = "(list_inner_product(a.v, a.v) + list_inner_product(b.v, b.v) - 2 * list_inner_product(a.v, b.v))"


def _floor_mean(x: str) -> str:
    return f"((sum({x}::bigint) - ((sum({x}::bigint) % count(*)) + count(*)) % count(*)) // count(*))::double"


def _rounds(rounds: int) -> str:
    """Assignments a0, a1, ... of the rows of ``pieces`` (id, p, v) to the centres c0, c1, ... (p, c, v)."""
    out = []
    for i in range(rounds + 1):
        out.append(
            f"""a{i} as materialized (
  select id, p, any_value(a.v) as v, min({{'d': {SQUARED}, 'c': c}}) as best from pieces a join c{i} b using (p) group by id, p)"""
        )
        if i < rounds:
            out.append(
                f"""c{i + 1} as materialized (
  select old.p, old.c, coalesce(new.v, old.v) as v from c{i} old left join (
    select p, c, list(m order by pos) as v from (
      select p, best.c as c, pos, {_floor_mean("v[pos]")} as m from (select *, unnest(range(1, len(v) + 1)) as pos from a{i}) group by all)
    group by p, c) new using (p, c))"""
            )
    return ",\n".join(out)


ORACLES["op11_clusters"] = f"""
with pieces as materialized (
  select vec_id as id, 0 as p, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings where {USABLE} and len(embedding) = 64),
c0 as materialized (
  select 0 as p, row_number() over (order by sha256('1:' || id)) - 1 as c, v from pieces qualify c < 16),
{_rounds(3)}
select id as vec_id, best.c::int as cluster, best.d::bigint as distance,
       (sum(best.d) over (partition by best.c))::bigint as cluster_inertia, (sum(best.d) over ())::bigint as inertia,
       sha256(array_to_string(list_transform(c3.v, lambda x: x::bigint), ',')) as centroid_sha256
from a3 join c3 on c3.c = best.c
"""

ORACLES["op12_codes"] = f"""
with kept as materialized (
  select vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::double)) as v from embeddings where {USABLE} and len(embedding) % 8 = 0 and len(embedding) > 0),
whole as materialized (select * from kept where len(v) = (select len(v) from kept group by len(v) order by count(*) desc, len(v) limit 1)),
pieces as materialized (
  select vec_id as id, p, v[p * len(v) // 8 + 1 : (p + 1) * len(v) // 8] as v from (select *, unnest(range(8)) as p from whole)),
c0 as materialized (select p, row_number() over (partition by p order by id) - 1 as c, v from pieces qualify c < 16),
{_rounds(6)},
coded as (
  select id, string_agg(printf('%02x', best.c), '' order by p) as code, sum(best.d)::bigint as error from a6 group by id),
books as (select sha256(string_agg(array_to_string(list_transform(v, lambda x: x::bigint), ','), ',' order by p, c)) as codebooks_sha256 from c6)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from coded join whole on vec_id = id, books
"""


@query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    archive = warc.write_archives(pages, f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")
    captures = warc.look_up(warc.build_index(archive), pages, "url", "page_id")
    read = warc.read_records(archive.folder, captures, with_payload=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op13_warc"] = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
f as (select *, min(page_id) over (partition by payload_digest) as first_id from p)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
       case when payload_bytes >= 100 and first_id <> page_id then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and first_id <> page_id then first_id end as refers_to
from f
"""


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
