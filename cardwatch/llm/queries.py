"""The registered queries of the operators over their whole tables, and SQL twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.llm import (conversation_repair, exact_topk, forest_search, mixing, ngram_join, packing, personal_data,
                           quality, sharding, suffix_dedup, token_alignment, toxicity, warc)
from cardwatch.llm.common import table
from cardwatch.session import pin

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[key] = lambda spark, sf_dir: fn(pin(spark), sf_dir)
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return register


@query("op1_shard")
def op1_shard(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op2_suffix_dedup")
def op2_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.digests(docs, keep_first=False)


@query("op3_toxicity")
def op3_toxicity(spark, sf_dir):
    rated = toxicity.rated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return rated.drop("text")


@query("op4_nearest")
def op4_nearest(spark, sf_dir):
    return forest_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op5_pack")
def op5_pack(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op6_quality")
def op6_quality(spark, sf_dir):
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_ngram_join", """
with recursive worded as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') as words
    from documents
), sets as (
    select doc_id, case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
        else list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) end as grams
    from worded
), entries as (
    select doc_id, len(grams) as n, unnest(grams) as gram from sets
), links as (
    select a.doc_id as x, b.doc_id as y
    from entries a join entries b on a.gram = b.gram and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach as (
    select doc_id as x, doc_id as y from documents union select r.x, l.y from reach r join links l on r.y = l.x
), least as (
    select x, min(y) as component_id from reach group by x
)
select doc_id, cast(len(grams) as bigint) as n_shingles, component_id from sets join least on x = doc_id
""")
def op7_ngram_join(spark, sf_dir):
    return ngram_join.join_classes(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op8_mix")
def op8_mix(spark, sf_dir):
    """``shards`` are the output shards of the document's copies, as the splitting tree has dealt them."""
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", F.array_sort(F.col("copies.shard")).alias("shards"))


@query("op9_topk", """
with whole as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as double)) as v
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.v, c.v) as bigint) as score
    from whole q join whole c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
), ranked as (
    select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
""")
def op9_topk(spark, sf_dir):
    return exact_topk.exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op10_warc", """
with measured as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
    from pages
), firsts as (
    select *, min(page_id) over (partition by payload_digest) as first from measured
)
select page_id, payload_bytes, payload_digest,
    case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
    case when payload_bytes >= 100 and page_id <> first then first end as refers_to
from firsts
""")
def op10_warc(spark, sf_dir):
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


@query("op11_repair")
def op11_repair(spark, sf_dir):
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


@query("op12_personal_data")
def op12_personal_data(spark, sf_dir):
    return personal_data.find(table(spark, sf_dir, "documents"))


@query("op13_align")
def op13_align(spark, sf_dir):
    return token_alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                 public_tokenizers.path("piece_bpe_32k.model"))
