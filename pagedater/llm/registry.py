"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagedater.llm import (
    attention,
    decontaminate,
    language,
    merkle,
    packing,
    quality,
    secrets,
    simhash,
    suffixes,
    token_counts,
    topk,
    warc,
    whitening,
)
from pagedater.llm.common import table
from pagedater.session import staging_path


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "warc")
    return warc.archive_index(warc.deduplicated_archives(table(spark, sf_dir, "pages"), path))


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.occurrences(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.scores(table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk": op1_topk,
    "op2_quality": op2_quality,
    "op3_warc": op3_warc,
    "op4_suffixes": op4_suffixes,
    "op5_simhash": op5_simhash,
    "op6_decontaminate": op6_decontaminate,
    "op7_language": op7_language,
    "op8_attention": op8_attention,
    "op9_secrets": op9_secrets,
    "op10_packing": op10_packing,
    "op11_tokens": op11_tokens,
    "op12_whitening": op12_whitening,
    "op13_merkle": op13_merkle,
}

OP1 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 100 = 0
), ranked as (
  select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::integer as rank,
         vec_id, score
  from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""

OP3 = """
with p as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as hex from pages
), parts as (
  select page_id, octet_length(encode(payload)) as payload_bytes, hex,
         list_transform(range(32), lambda i: (
           list_reduce(list_transform(range(5), lambda j: (
             ((strpos('0123456789abcdef', substr(hex, (i * 5 + j) // 4 + 1, 1)) - 1) >> (3 - (i * 5 + j) % 4)) & 1
           )), lambda a, b: a * 2 + b))) as digits
  from p
), d as (
  select page_id, payload_bytes,
         list_aggregate(list_transform(digits, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x::int + 1, 1)),
                        'string_agg', '') as payload_digest
  from parts
), o as (
  select *, max(page_id) over (partition by payload_digest) as original from d
)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
       case when page_id = original then 'response' else 'revisit' end as record_type,
       case when page_id <> original then original end as refers_to
from o
"""

# crc32 bit by bit, as the language has no such function.
OP13 = """
with recursive d as (
  select doc_id, lang, sha256(concat(
           coalesce(strlen(doc_id::varchar) || ':' || doc_id::varchar, '-'), coalesce(strlen(source) || ':' || source, '-'),
           coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::varchar) || ':' || n_chars::varchar, '-'),
           coalesce(strlen(text) || ':' || text, '-'))) as leaf,
         sha256(concat(
           coalesce(strlen(doc_id::varchar) || ':' || doc_id::varchar, '-'), coalesce(strlen(source) || ':' || source, '-'),
           coalesce(strlen(lang) || ':' || lang, '-'),
           coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1)::varchar, '-'),
           coalesce(strlen(text) || ':' || text, '-'))) as changed,
         xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::ubigint)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)::ubigint[]),
             lambda x, i: case when x % 2 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end)), 4294967295::ubigint) as crc
  from documents
), l as (
  select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos,
         case when crc % 7 = 0 then changed else leaf end as used,
         dense_rank() over (order by lang nulls first) - 1 as tree
  from d
), nodes as (
  select 0 as lvl, tree, pos, leaf as h from l
  union all
  select lvl + 1, tree, pos // 2, sha256(string_agg(h, '' order by pos))
  from (select *, count(*) over (partition by tree) as n from nodes) where n > 1
  group by lvl, tree, pos // 2
), subroots as (
  select tree, max(lvl) as lvl, arg_max(h, lvl) as h from nodes group by tree
), uppers as (
  select 0 as lvl, tree as pos, h from subroots
  union all
  select lvl + 1, pos // 2, sha256(string_agg(h, '' order by pos))
  from (select *, count(*) over () as n from uppers) where n > 1
  group by lvl, pos // 2
), top as (
  select max(lvl) as lvl, arg_max(h, lvl) as h from uppers
), steps as (
  select l.tree, l.pos, range as step, range as lvl, l.tree as key, l.pos >> range as at, true as below
  from l join subroots s using (tree), range(0, 64) where range < s.lvl
  union all
  select l.tree, l.pos, s.lvl + range, range, null, l.tree >> range, false
  from l join subroots s using (tree), top, range(0, 64) where range < top.lvl
), siblings as (
  select t.tree, t.pos, t.step, coalesce(n.h, u.h) as h, t.at % 2 = 1 as on_left
  from steps t left join nodes n on t.below and n.lvl = t.lvl and n.tree = t.key and n.pos = xor(t.at, 1)
               left join uppers u on not t.below and u.lvl = t.lvl and u.pos = xor(t.at, 1)
), paths as (
  select tree, pos, string_agg(h, '' order by step) as joined,
         list(struct_pack(h := h, on_left := on_left) order by step) as path
  from siblings group by tree, pos
), folds as (
  select l.doc_id, l.leaf, s.h as subroot, top.h as root, sha256(coalesce(p.joined, '')) as proof_sha256,
         case when p.path is null then l.used else list_reduce(
           list_prepend(struct_pack(h := l.used, on_left := false), p.path),
           lambda a, b: struct_pack(h := sha256(
             case when b.h is null then a.h when b.on_left then b.h || a.h else a.h || b.h end), on_left := false)).h
         end as folded_root
  from l join subroots s using (tree) cross join top left join paths p using (tree, pos)
)
select *, folded_root = root as verified from folds
"""

ORACLES: dict[str, str] = {"op1_topk": OP1, "op3_warc": OP3, "op13_merkle": OP13}
