"""The registered queries of the corpus operators over whole tables, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bilinear_lm,
    exact_dedup,
    lang_id,
    lexical,
    licences,
    mixing,
    near_join,
    pieces,
    quality_net,
    repeats,
    sharding,
    spelling,
    top_k,
)
from .common import table

PIECES = "/opt/tokenizers/piece_bpe_32k.model"  # a public vocabulary, present on every executor
BEST = 8  # segmentations of each text
MIX = {"source": 0.8, "lang": 0.9, "topic": 1.0}  # exponents on the corpus's own shares


def op1_quality_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    net = quality_net.train(documents, table(spark, sf_dir, "labels"))
    return quality_net.score_quality(documents, net)


def op2_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.find_repeats(table(spark, sf_dir, "documents"), window=400)
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256"
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard_documents(table(spark, sf_dir, "documents"), shards=24)
    return dealt.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bilinear_lm.score_documents(table(spark, sf_dir, "documents"))


def op5_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_join.link_classes(table(spark, sf_dir, "documents"), words=4, percent=85)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.find_licences(table(spark, sf_dir, "documents"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.exact_top_k(table(spark, sf_dir, "embeddings"), k=10, every=100, scale=1024)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.sample_to_targets(table(spark, sf_dir, "documents"), MIX)


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"), PIECES, n=BEST)


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"), min_length=6, min_count=5, spoil_every=199, ratio=5)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return lang_id.identify(documents, lang_id.train(documents))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_net,
        op2_repeat_removal,
        op3_sharding,
        op4_lm_scores,
        op5_near_join,
        op6_exact_dedup,
        op7_licences,
        op8_top_k,
        op9_mixing,
        op10_pieces,
        op11_ranked_search,
        op12_spelling_groups,
        op13_language_id,
    )
}

ORACLES: dict[str, str] = {
    "op6_exact_dedup": r"""
        with texts as (
            select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents
        ), groups as (
            select t, min(doc_id) as keep_id, count(*) as group_size from texts group by t
        )
        select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(t) as text_sha256
        from texts join groups using (t)
    """,
    "op8_top_k": """
        with vectors as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
            from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select q.vec_id as query_id, c.vec_id,
                   list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
            from vectors q join vectors c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id
        ), ranked as (
            select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank,
                   vec_id, score
            from scored
        )
        select query_id, rank, vec_id, score from ranked where rank <= 10
    """,
    "op11_ranked_search": r"""
        with numbered as (
            select row_number() over () as d, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
            from documents
        ), postings as (
            select d, doc_id, term, count(*) as tf
            from (select d, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from numbered)
            group by all
        ), lengths as (
            select d, sum(tf)::bigint as n from postings group by d
        ), corpus as (
            select count(*) as docs, sum(n)::bigint as total from lengths
        ), weights as (
            select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w from postings, corpus group by term, docs
        ), asked as (
            select distinct item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from benchmark
        ), scored as (
            select item_id, d, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::bigint as score
            from asked join postings using (term) join weights using (term) join lengths using (d), corpus
            group by all
        ), ranked as (
            select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score
            from scored where score > 0
        )
        select item_id, rank, doc_id, score from ranked where rank <= 50
    """,
    "op12_spelling_groups": r"""
        with recursive remainders(b, c, step) as (
            select b::uinteger, b::uinteger, 0 from range(256) t(b)
            union all
            select b, case when c & 1 = 1 then xor(c >> 1, 3988292384::uinteger) else c >> 1 end, step + 1
            from remainders where step < 8
        ), crc_table as (
            select list(c order by b) as entry from remainders where step = 8
        ), runs as (
            select doc_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) as run
            from documents
        ), counted as (
            select doc_id, run, count(*) as times from runs where length(run) >= 6 group by all
        ), bytes as (
            select run, times, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) as h from counted
        ), hashed as (
            select run, times, xor(4294967295::uinteger, list_reduce(
                list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::uinteger),
                lambda c, x: xor(c >> 8, entry[(xor(c, x) & 255) + 1]), 4294967295::uinteger)) as crc
            from bytes, crc_table
        ), spoiled as (
            select case when crc % 199 = 0
                then substr(run, 1, (crc % length(run))::int) || substr(run, (crc % length(run))::int + 2) else run end as word, times
            from hashed
        ), words as (
            select word, sum(times)::bigint as n from spoiled where length(word) >= 6 group by word having sum(times) >= 5
        ), holes as (
            select word, cut, substr(word, 1, cut - 1) || substr(word, cut + 1) as rest
            from (select word, unnest(range(1, length(word) + 1)) as cut from words)
        ), near as (
            select a.word, b.word as other from holes a join holes b on a.cut = b.cut and a.rest = b.rest and a.word <> b.word
            union
            select h.word, w.word from holes h join words w on h.rest = w.word
            union
            select w.word, h.word from holes h join words w on h.rest = w.word
        ), ranked as (
            select near.word, other, o.n as other_n, count(*) over (partition by near.word) as n_near,
                   row_number() over (partition by near.word order by o.n desc, other) as place
            from near join words o on o.word = other
        ), known as (
            select w.word, case when other_n >= 5 * n then other end as form, n, coalesce(n_near, 0) as n_near,
                   case when other_n >= 5 * n then other_n end as form_n
            from words w left join ranked r on r.word = w.word and place = 1
        ), paths(word, root) as (
            select word, word from words
            union all
            select p.word, k.form from paths p join known k on k.word = p.root where k.form is not null
        )
        select k.word, k.form, p.root, k.n, k.n_near::bigint as n_near, k.form_n
        from known k join paths p on p.word = k.word join known last on last.word = p.root and last.form is null
    """,
}
