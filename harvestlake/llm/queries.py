"""The registered queries of the operators, each over its whole table, with reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestlake.llm import (
    exact_dedup,
    hard_negatives,
    language,
    licences,
    mixing,
    near_dedup,
    quality,
    sentencepiece,
    simhash,
    spelling,
    token_counts,
    toxicity,
    warc,
)
from harvestlake.llm.common import fold, stage, table, text_of
from harvestlake.operators.joins import join_to_one

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
REFERENCE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            REFERENCE_SQL[name] = sql
        return function

    return add


def tokenizer_path(name: str) -> str:
    """A file of the public tokenizers installed on the machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_mixing")
def mixing_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of all documents at 90 % of the sources' greatest entropy at least."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs).select("doc_id", "source", "mix.*")


NEAR_SQL = """
with recursive w as (
  select doc_id, list_filter(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words from documents),
s as (
  select doc_id, list_distinct(case when len(words) = 0 then []
    when len(words) < 4 then [array_to_string(words, ' ')]
    else list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) end) as shingles from w),
cls as (select doc_id, shingles, min(doc_id) over (partition by list_sort(shingles)) as head from s),
e as (select doc_id as id, unnest(shingles) as sh, len(shingles) as n from cls where head = doc_id),
p as (select a.id as a, b.id as b, count(*) as both_, any_value(a.n) as an, any_value(b.n) as bn
      from e a join e b on a.sh = b.sh and a.id < b.id group by a.id, b.id),
l as (select a as u, b as v from p where 100 * both_ >= 80 * (an + bn - both_)
      union all select b, a from p where 100 * both_ >= 80 * (an + bn - both_)),
r(id, least_) as (
  select distinct doc_id, doc_id from cls where head = doc_id
  union select l.v, r.least_ from r join l on l.u = r.id where r.least_ < l.v),
c as (select id, min(least_) as component from r group by id)
select cls.doc_id, cast(len(shingles) as bigint) as n_shingles,
  case when len(shingles) = 0 then cls.doc_id else component end as component_id,
  case when len(shingles) = 0 then true else component = cls.doc_id end as kept
from cls left join c on c.id = cls.head
"""


@query("op2_minhash_near_dedup", NEAR_SQL)
def near_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"), words=4)


@query("op3_token_counts")
def token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


@query("op4_quality")
def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 5) == 0
    ensemble = quality.fit_quality(docs, table(spark, sf_dir, "labels"), held_out)
    return quality.score_quality(docs, ensemble).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query("op5_licence_scan")
def licence_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence paragraphs of every whole text: one row per document, with the confirmed families."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licences.scan(docs, licences.fit_licences(docs))
    confirmed = F.filter("licences", lambda p: p["confirmed"])
    return found.select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct(F.transform(confirmed, lambda p: p["family"]))), ",").alias("families"),
        F.size(confirmed).alias("n_confirmed"),
        (F.size("licences") - F.size(confirmed)).alias("n_unconfirmed"),
        F.coalesce(F.round(F.array_max(F.transform(confirmed, lambda p: p["probability"])), 4), F.lit(0.0)).alias("probability"),
    )


@query("op6_sentencepiece")
def sentencepiece_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every whole text, the round trip of each, and parity with the library."""
    docs = table(spark, sf_dir, "documents").select("doc_id", text_of().alias("text"))
    coded = sentencepiece.encode_documents(docs, tokenizer_path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.octet_length("text").cast("bigint").alias("n_bytes"),
        "piece_facts.*",
        F.xxhash64("piece_ids").alias("ids_hash"),
    )


@query("op8_toxicity")
def toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 4) == 2
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"), held_out)
    return toxicity.score_documents(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


WARC_SQL = """
with p as (select page_id, coalesce(html, '') as html, min(page_id) over (partition by coalesce(html, '')) as first_id
           from pages),
d as (select *, unhex(sha1(html)) as raw from p)
select page_id, cast(strlen(html) as bigint) as payload_bytes, to_base32_ as payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id <> first_id then first_id end as refers_to
from (select *, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(('0b' || substr(bits, 1 + 5 * i, 5))::bigint as int), 1)), '') as to_base32_
  from (select *, array_to_string(list_transform(range(0, 40), lambda i:
    lpad(bin(('0x' || substr(sha1(html), 1 + i, 1))::bigint), 4, '0')), '') as bits from d))
"""


@query("op7_warc", WARC_SQL)
def warc_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


@query("op9_simhash")
def simhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of texts and edited texts; for each twentieth id also how many other
    fingerprints of the whole table are within 3 bits of its own."""
    found = simhash.edited_likeness(table(spark, sf_dir, "documents"))
    prints = stage(found, "simhash")
    asked = prints.where(F.col("doc_id") % 20 == 0)
    near = simhash.neighbours(asked, prints).groupBy(F.col("a").alias("fingerprint")).agg(F.count("*").alias("n"))
    return join_to_one(prints, near, ["fingerprint"]).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        simhash.as_hex(F.col("fingerprint")).alias("fingerprint"),
        simhash.as_hex(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.when(F.col("doc_id") % 20 == 0, F.coalesce("n", F.lit(0))).alias("n_near_fingerprints"),
    )


EXACT_SQL = """
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
  doc_id = max(doc_id) over g as kept, sha256(coalesce(text, '')) as text_sha256
from documents window g as (partition by coalesce(text, ''))
"""


@query("op10_exact_dedup", EXACT_SQL)
def exact_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


HARD_NEGATIVES_SQL = """
with v as (
  select vec_id, cast(coalesce(case when vec_id % 7 = 0 then (label + 1) % 10 end, label) as bigint) as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, a.label as anchor_label, b.vec_id as id, b.label,
    cast(list_inner_product(a.e, b.e) as bigint) as score
  from v a, v b where a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
p as (
  select anchor_id, id as positive_id, score as positive_score from s where label = anchor_label
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5)
select p.anchor_id, positive_id, cast(row_number() over w as int) as rank, s.id as negative_id,
  positive_score, s.score as negative_score
from p join s on s.anchor_id = p.anchor_id and s.label <> s.anchor_label
  and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score
window w as (partition by p.anchor_id, positive_id order by s.score desc, s.id)
qualify row_number() over w <= 10
"""


@query("op11_hard_negatives", HARD_NEGATIVES_SQL)
def hard_negatives_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    rows = hard_negatives.prepared(table(spark, sf_dir, "embeddings"), moved)
    return hard_negatives.mine(rows, rows.where(F.col("vec_id") % 100 == 0))


SPELLING_SQL = """
with recursive bits(b, k, x) as (
  select b, 0, cast(b as ubigint) from range(256) t(b)
  union all select b, k + 1, case when x % 2 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end from bits where k < 8),
crc as (select list(x order by b) as x from bits where k = 8),
runs as (
  select doc_id, run, count(*) as n from (
    select doc_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) as run
    from documents) where length(run) >= 7 group by doc_id, run),
h as (
  select run, n, cast(xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(range(0, strlen(key) ),
      lambda i: cast(('0x' || substr(hex(encode(key)), cast(2 * i + 1 as int), 2))::int as ubigint))),
    lambda a, b: xor(a >> 8, list_extract(crc.x, cast(xor(a, b) & 255 as bigint) + 1))), 4294967295::ubigint) as bigint) as h
  from (select *, coalesce(cast(doc_id as varchar), '') || ':' || run as key from runs), crc),
w as (
  select word, cast(sum(n) as bigint) as n from (
    select case when h % 31 = 0 then left(run, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from h)
  where length(word) >= 7 group by word having sum(n) >= 2),
d as (
  select word, n, i, left(word, i - 1) || substr(word, i + 1) as less, left(word, i - 1) || '_' || substr(word, i + 1) as hole
  from (select word, n, unnest(range(1, length(word) + 1)) as i from w)),
l as (
  select a.word as u, b.word as v, b.n from d a join d b on a.hole = b.hole and a.word <> b.word
  union select a.word, b.word, b.n from d a join w b on a.less = b.word
  union select b.word, a.word, a.n from d a join w b on a.less = b.word),
best as (select u, count(*) as n_near, max(n) as top, arg_min(v, (-n, v)) as v from l group by u),
f as (
  select w.word, case when top >= 10 * w.n then v end as form, w.n, coalesce(n_near, 0) as n_near,
    case when top >= 10 * w.n then top end as form_n
  from w left join best on best.u = w.word),
r(word, root) as (
  select word, word from f union all select r.word, f.form from r join f on f.word = r.root where f.form is not null)
select f.word, form, coalesce(last_.root, f.word) as root, f.n, n_near, form_n
from f left join (select r.word, r.root from r join f on f.word = r.root where f.form is null) last_ on last_.word = f.word
"""


@query("op12_spelling", SPELLING_SQL)
def spelling_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(table(spark, sf_dir, "documents"))


@query("op13_language")
def language_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = fold("doc_id", 3) == 1
    model = language.fit_languages(docs, held_out)
    return language.label_documents(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.size("language.spans").alias("n_spans"),
    )
