"""Registered queries of the operators, over whole tables, and the SQL of those that SQL
can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm.common import table
from adloom.llm.conversations import damaged, repaired
from adloom.llm.decontamination import leaked_pairs
from adloom.llm.histogram_packing import pack_by_histogram
from adloom.llm.negatives import hard_negatives
from adloom.llm.packing import pack_documents
from adloom.llm.secrets import count_of, find_secrets, spans_text
from adloom.llm.sharding import assign_shards
from adloom.llm.simhash import near_duplicates
from adloom.llm.sketches import fingerprints
from adloom.llm.substrings import without_repeats
from adloom.llm.toxicity import fit, held_out, score
from adloom.llm.urlfilter import judge_urls
from adloom.llm.warc import read_archive, write_archive
from adloom.session import work_folder

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 40
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def tokenizer() -> tuple[str, str]:
    """The public 50k byte-level BPE as ranks, and its pattern. The same vocabulary is in
    ``byte_bpe_50k.json``; the ids are equal, and read from ranks they cost a fifth."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def op1_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op4_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op2_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = write_archive(table(spark, sf_dir, "pages"), work_folder(spark, "archive"))
    return read_archive(frames).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"), SHARDS)


def op6_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), *tokenizer())


def op7_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.col("base")
    return found.select(
        "doc_id",
        count_of(base, "assign").alias("n_assign"),
        count_of(base, "access").alias("n_access"),
        count_of(base, "hex").alias("n_hex"),
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def op9_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


def op10_url_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def op11_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_by_histogram(table(spark, sf_dir, "documents"), *tokenizer())


def op12_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_streamed_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(damaged(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Query] = {
    "op1_compression_toxicity": op1_compression_toxicity,
    "op4_string_tiling": op4_string_tiling,
    "op2_seekable_warc": op2_seekable_warc,
    "op5_hilbert_shards": op5_hilbert_shards,
    "op6_best_two_fit": op6_best_two_fit,
    "op7_golay_simhash": op7_golay_simhash,
    "op3_scaled_sketch": op3_scaled_sketch,
    "op8_randomness_battery": op8_randomness_battery,
    "op9_suffix_trees": op9_suffix_trees,
    "op10_url_digests": op10_url_digests,
    "op11_shortest_pack_first": op11_shortest_pack_first,
    "op12_inverted_multi_index": op12_inverted_multi_index,
    "op13_streamed_repair": op13_streamed_repair,
}

ORACLES: dict[str, str] = {
    "op2_seekable_warc": """
with p as (
  select page_id, coalesce(html, '') as html from pages
), d as (
  select page_id, octet_length(encode(html)) as payload_bytes, sha256(html) as payload_digest from p
), f as (
  select *, min(page_id) over (partition by payload_digest) as first_page from d
)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first_page then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first_page then first_page end as refers_to
from f
""",
    "op9_suffix_trees": r"""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents
), s as (
  select doc_id, unnest(generate_series(1, len(words) - 49)) as k, words from w where len(words) >= 50
), h as (
  select doc_id, k, array_to_string(words[k:k + 49], ' ') as win from s
), f as (
  select win, min(doc_id) as first_doc from h group by win
), r as (
  select h.doc_id, list(h.k) as ks from h join f using (win) where h.doc_id > f.first_doc group by h.doc_id
), c as (
  select r.doc_id, list(distinct j) as gone
  from (select doc_id, unnest(ks) as k from r) r, lateral (select unnest(generate_series(k, k + 49)) as j) group by r.doc_id
), o as (
  select w.doc_id, len(w.words) as n_words, coalesce(len(c.gone), 0) as n_removed,
    case when c.gone is null then w.words
      else list_filter(w.words, lambda x, i: not list_contains(c.gone, i)) end as kept
  from w left join c using (doc_id)
)
select doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) as kept_sha256 from o
""",
    "op10_url_digests": r"""
with u as (
  select page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') as path
  from pages
), r(h, p, action) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), m as (
  select u.page_id, u.host, u.path, h || p as rule, action,
    row_number() over (partition by u.page_id order by length(h || p) desc nulls last) as k
  from u left join r on (u.host = h or ends_with(u.host, '.' || h)) and starts_with(u.path, p)
)
select page_id, host, path, rule, coalesce(action, 'allow') as verdict from m where k = 1
""",
    "op12_inverted_multi_index": """
with v as (
  select row_number() over () as k, vec_id,
    case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select a.k as anchor, a.vec_id as anchor_id, b.k, b.vec_id, a.label = b.label as same,
    coalesce(list_sum(list_transform(range(1, least(len(a.v), len(b.v)) + 1), lambda i: a.v[i] * b.v[i])), 0)::bigint as score
  from v a join v b on a.k <> b.k where a.vec_id % 100 = 0
), p as (
  select * from s where same
  qualify row_number() over (partition by anchor order by score desc, vec_id nulls last, k) <= 5
), n as (
  select p.anchor_id, p.vec_id as positive_id, p.score as positive_score, s.vec_id as negative_id, s.score as negative_score,
    row_number() over (partition by p.anchor, p.k order by s.score desc, s.vec_id nulls last, s.k) as rank
  from p join s on s.anchor = p.anchor and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score
from n where rank <= 5
""",
    "op13_streamed_repair": r"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key
  from conversations
), faults as (
  select *, xor(4294967295, list_reduce(
    list_transform(range(length(key)), lambda i: ascii(substr(key, i + 1, 1))::bigint),
    lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(c, b)),
    4294967295)) % 20 as fault
  from keyed
), damaged as (
  select conv_id, turn, case when fault = 4 then 'user' else role end as role,
    case fault when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(case when fault = 3 then [0, 1] else [0] end) as copy
  from faults where fault <> 0
), numbered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as k,
    row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as seen,
    right(rtrim(text, E' \t\n\x0b\x0c\r'), 1) as last_char
  from damaged
), marked as (
  select *, left(role, 1) as initial, last_char = '' as blank, last_char <> '' and seen as duplicate,
    last_char <> '' and not seen and last_char not in ('.', '!', '?') as truncated,
    lag(left(role, 1)) over (partition by conv_id order by k) || left(role, 1) as pair
  from numbered
), counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (blank) as blank, count(*) filter (duplicate) as duplicate,
    count(*) filter (truncated) as truncated,
    count(*) filter (pair not in ('su', 'ua', 'au')) as illegal, count(*) as n
  from marked group by conv_id
), inserts(state, n, after, line) as (
  values (0, 0, 0, ''), (1, 0, 1, ''), (2, 0, 2, ''), (3, 0, 3, ''),
    (0, 1, 2, E'\nuser:'), (1, 1, 2, E'\nuser:'), (2, 1, 3, E'\nassistant:'), (3, 1, 2, E'\nuser:'),
    (0, 2, 3, E'\nuser:\nassistant:'), (1, 2, 3, E'\nuser:\nassistant:'),
    (2, 2, 2, E'\nassistant:\nuser:'), (3, 2, 3, E'\nuser:\nassistant:')
), edits(edit, origin, initial, after, cost, made) as (
  values ('D', 0, null, 0, 4, null), ('D', 1, null, 1, 4, null), ('D', 2, null, 2, 4, null), ('D', 3, null, 3, 4, null),
    ('K', 0, 's', 1, 0, null), ('K', 0, 'u', 2, 0, null), ('K', 1, 'u', 2, 0, null), ('K', 3, 'u', 2, 0, null),
    ('K', 2, 'a', 3, 0, null), ('R', 0, null, 2, 3, 'user'), ('R', 1, null, 2, 3, 'user'),
    ('R', 3, null, 2, 3, 'user'), ('R', 2, null, 3, 3, 'assistant')
), step as (
  select conv_id, 0::bigint as k, 0 as state, {'cost': 0::bigint, 'audit': '', 'lines': ''} as best
  from (select distinct conv_id from conversations)
  union all
  select s.conv_id, s.k + 1, e.after,
    min({'cost': s.best.cost + 3 * i.n + e.cost + case when m.truncated and e.edit <> 'D' then 3 else 0 end,
      'audit': s.best.audit || repeat('I', i.n) || e.edit,
      'lines': s.best.lines || i.line || case e.edit when 'D' then ''
        else E'\n' || coalesce(e.made, m.role) || ':' || m.text end})
  from step s
    join marked m on m.conv_id is not distinct from s.conv_id and m.k = s.k + 1
    join inserts i on i.state = s.state
    join edits e on e.origin = i.after and (e.initial is null or e.initial = m.initial)
      and (e.edit = 'D' or not (m.blank or m.duplicate))
  group by s.conv_id, s.k, e.after
), ended as (
  select s.conv_id, min({'cost': s.best.cost + 3 * i.n, 'audit': s.best.audit || repeat('I', i.n),
    'lines': s.best.lines || i.line}) as best
  from step s left join counted c on c.conv_id is not distinct from s.conv_id
    join inserts i on i.state = s.state and i.after in (0, 3)
  where s.k = coalesce(c.n, 0) group by s.conv_id
)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, best.cost as cost,
  best.audit as audit, sha256(substr(best.lines, 2)) as repaired_sha256
from ended e left join counted c on c.conv_id is not distinct from e.conv_id
""",
}
