"""Registered queries of the training-data operators, each over its whole
table with production parameters, and their DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodlake.llm import (byte_bpe, centroid_clusters, exact_dedup, jaccard_join, language_id, license_scan, minhash_join, packing,
                          periodic_runs, secret_scan, sharding, token_counts, topk)
from moodlake.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the rows whose vec_id is divisible by 100; candidates are all rows."""
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                           public_tokenizers.PATTERN, digests=True)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(documents(spark, sf_dir), plant=True)


def op12_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_join.near_copies(documents(spark, sf_dir))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.cluster_report(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_exact_dedup, op2_license_scan, op3_jaccard_join, op4_language_id, op5_packing, op6_sharding, op7_token_counts, op8_secret_scan,
    op9_topk, op10_byte_bpe, op11_periodic_runs, op12_minhash_join, op13_centroid_clusters)}

OP1_SQL = r"""
with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
           from documents)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
       row_number() over (partition by text_sha256 order by doc_id nulls last) = 1 as kept, text_sha256
from d window g as (partition by text_sha256)"""


def _jump_sql(shards: int) -> str:
    """The jump walk as a recursive query over (doc_id, state, shard, next)."""
    return f"""
  select distinct doc_id, case when coalesce(doc_id, 0) < 0 then coalesce(doc_id, 0)::hugeint + 18446744073709551616
                               else coalesce(doc_id, 0)::hugeint end as s, -1::bigint as cur, 0::bigint as nxt
  from documents
  union all
  select doc_id, s2 as s, nxt as cur,
         trunc((nxt + 1)::double * (2147483648::double / ((s2 // 8589934592) + 1)::double))::bigint as nxt
  from (select doc_id, nxt, (s * 2862933555777941757 + 1) % 18446744073709551616 as s2 from j{shards} where nxt < {shards})"""


# CRC-32 by the reflected polynomial, a table of 256 entries made from its rule
OP6_SQL = f"""
with recursive j8 as ({_jump_sql(8)}), j9 as ({_jump_sql(9)}),
s8 as (select doc_id, max(cur)::int as shard from j8 group by doc_id),
s9 as (select doc_id, max(cur)::int as grown_shard from j9 group by doc_id),
t as (select list(v order by n) as crc_table from (
  select n, list_reduce(list_prepend(n::bigint, range(8)),
         lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v from range(256) r(n))),
d as (select doc_id, octet_length(encode(coalesce(text, ''))) + 1 as size,
             case when coalesce(text, '') = '' then 0 else
             xor(list_reduce(list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(text)), '..'),
                 lambda x: ('0x' || x)::bigint)),
                 lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295) end as text_crc32
      from documents, t),
r as (select greatest(1, ceil(count(*) / 20000.0))::bigint as ranges from documents),
p as (select d.*, s8.shard, s9.grown_shard,
             (((case when coalesce(d.doc_id, 0) < 0 then coalesce(d.doc_id, 0)::hugeint + 18446744073709551616
                else coalesce(d.doc_id, 0)::hugeint end * 2862933555777941757 + 1) % 18446744073709551616
               // 8589934592) * ranges // 2147483648)::bigint as place
      from d join s8 on d.doc_id is not distinct from s8.doc_id join s9 on d.doc_id is not distinct from s9.doc_id, r)
select doc_id, size, text_crc32, 'key' as law, shard,
       row_number() over (partition by shard order by place, doc_id, text_crc32, size) - 1 as slot, grown_shard
from p"""


def _near_sql(words: int, columns: str) -> str:
    """All pairs of documents that share a shingle, and what links reach."""
    return rf"""
with recursive w as (
  select row_number() over () as r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
s as (select r, doc_id, case when len(w) = 0 then []::varchar[] else list_distinct(list_transform(
             range(1, greatest(2, len(w) - {words - 2})), lambda i: array_to_string(w[i:i + {words - 1}], ' '))) end as shingles from w),
e as (select r, len(shingles) as n, unnest(shingles) as shingle from s),
shared as (select a.r as a, b.r as b, any_value(a.n) as n_a, any_value(b.n) as n_b, count(*) as n_both
           from e a join e b on a.shingle = b.shingle and a.r <> b.r group by a.r, b.r),
links as (select a, b from shared where 100 * n_both >= 80 * (n_a + n_b - n_both)),
reach as (select r as a, r as b from s union select reach.a, links.b from reach join links on reach.b = links.a),
c as (select r, doc_id, len(shingles) as n_shingles, case when len(shingles) = 0 then doc_id else
             min(doc_id) over (partition by md5(array_to_string(list_sort(shingles), chr(10)))) end as class_id from s)
select c.doc_id, c.n_shingles, min(o.doc_id) as component_id, {columns}c.class_id
from c join reach on reach.a = c.r join c o on o.r = reach.b group by c.r, c.doc_id, c.n_shingles, c.class_id"""


OP3_SQL = _near_sql(5, "")
OP12_SQL = _near_sql(2, "c.doc_id is not distinct from min(o.doc_id) as kept, ")

OP9_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as e from embeddings
           where embedding is not null and vec_id is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::bigint as score
      from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id and len(q.e) = len(c.e))
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from s qualify rank <= 10"""

SQL: dict[str, str] = {"op1_exact_dedup": OP1_SQL, "op2_license_scan": license_scan.scan_sql(),
                       "op3_jaccard_join": OP3_SQL, "op6_sharding": OP6_SQL,
                       "op9_topk": OP9_SQL, "op12_minhash_join": OP12_SQL,
                       "op13_centroid_clusters": centroid_clusters.cluster_sql()}
