"""Registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorrel.llm import (
    conversation_repair, exact_dedup, hard_negatives, language_id, mixing, near_dedup, packing, simhash, substring_dedup,
    suffix_dedup, topk, toxicity, url_filter,
)
from sorrel.llm.common import crc_bucket, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_best_fit_packing(spark, d):
    return packing.pack(table(spark, d, "documents"))


@query
def op4_url_filter(spark, d):
    return url_filter.judge_urls(table(spark, d, "pages"))


ORACLE["op4_url_filter"] = r"""
with parts as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), split as (
  select page_id,
    translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '(?s)^[^/?#]*(/[^?#]*)', 1) as path
  from parts
), known as (
  select page_id, coalesce(host, '') as host, coalesce(path, '') as path from split
), rules(rule_host, rule_path, rule_verdict) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), fits as (
  select page_id, rule_host || rule_path as rule, rule_verdict,
    row_number() over (partition by page_id order by length(rule_host) desc, length(rule_path) desc) as nth
  from known join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select k.page_id, host, path, f.rule, coalesce(f.rule_verdict, 'allow') as verdict
from known k left join fits f on k.page_id = f.page_id and nth = 1
"""


@query
def op5_source_mixing(spark, d):
    return mixing.mix(table(spark, d, "documents"))


ORACLE["op5_source_mixing"] = """
with sizes as (
  select source, sum(greatest(coalesce(length(text), 0), 1)) as size from documents group by source
), rates as (
  select source, 1.0::double * (sum(size) over ())::double / ((count(*) over ())::double * size::double) as rate from sizes
), terms as (
  select source, k, case when rate = 0 then (k = 0)::int::double
    else exp(-rate + k * ln(rate) - lgamma(k + 1)) end as p
  from rates, range(0, 600) as r(k) where k <= rate + 12 * sqrt(rate) + 24
), cdf as (
  select source, k, sum(p) over (partition by source order by k) as c from terms
), drawn as (
  select *, ('0x' || substr(md5('mix-7:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint::double
    / 4503599627370496.0 as u from documents
), counted as (
  select d.doc_id, d.text, d.lang, d.source, d.n_chars,
    (select count(*) from cdf c where c.source is not distinct from d.source and c.c <= d.u) as n_copies
  from drawn d
)
select doc_id, text, lang, source, n_chars, n_copies::int as n_copies, unnest(range(0, n_copies))::int as copy from counted
where n_copies > 0
"""


@query
def op8_exact_dedup(spark, d):
    return exact_dedup.groups_of_equal_text(table(spark, d, "documents"))


ORACLE["op8_exact_dedup"] = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""


@query
def op1_language_id(spark, d):
    return language_id.identify(table(spark, d, "documents"))


@query
def op7_toxicity(spark, d):
    judged = toxicity.classify(table(spark, d, "documents"), table(spark, d, "labels"))
    return judged.select(
        "_doc.doc_id", (crc_bucket(F.col("_doc.doc_id"), 5) == 0).alias("held_out"), "score", "predicted"
    )


@query
def op10_topk_search(spark, d):
    return topk.top_k(table(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE["op10_topk_search"] = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
  from whole q join whole c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(c.v) = len(q.v)
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""


@query
def op9_minhash_near_dedup(spark, d):
    return near_dedup.near_duplicates(table(spark, d, "documents"), shingle=2, percent=80)


ORACLE["op9_minhash_near_dedup"] = r"""
with recursive lists as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents
), shingles as (
  select distinct doc_id, unnest(case when len(w) < 2 then list_transform(w, lambda x: [x])
    else list_transform(range(1, len(w)), lambda i: [w[i], w[i + 1]]) end) as s from lists
), sizes as (
  select l.doc_id, count(s) as n from lists l left join shingles h on h.doc_id = l.doc_id group by l.doc_id
), numbered as (
  select doc_id, n, dense_rank() over (order by s) as s from shingles join sizes using (doc_id)
), links as (
  select a.doc_id as a, b.doc_id as b from numbered a join numbered b on a.s = b.s and a.doc_id <> b.doc_id
    and 100 * a.n >= 80 * b.n and 100 * b.n >= 80 * a.n
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reached as (
  select doc_id as a, doc_id as b from lists union select r.a, l.b from reached r join links l on l.a = r.b
)
select z.doc_id, z.n as n_shingles, min(r.b) as component_id, z.doc_id = min(r.b) as kept
from sizes z join reached r on r.a = z.doc_id group by z.doc_id, z.n
"""


@query
def op2_substring_dedup(spark, d):
    return substring_dedup.remove_repeated_windows(table(spark, d, "documents"))


ORACLE["op2_substring_dedup"] = r"""
with lists as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), windows as (
  select doc_id, i, array_to_string(w[i : i + 19], ' ') as s from (select doc_id, w, unnest(range(1, len(w) - 18)) as i from lists)
), later as (
  select doc_id, i from (select doc_id, i, row_number() over (partition by s order by doc_id, i) as nth from windows) where nth > 1
), marked as (
  select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 20 then 0 else 1 end as fresh from later
), spans as (
  select doc_id, min(i) as a, max(i) + 20 as b from (
    select doc_id, i, sum(fresh) over (partition by doc_id order by i) as span from marked
  ) group by doc_id, span
), gone as (
  select doc_id, sum(b - a)::bigint as n_removed, list(a order by a) as starts, list(b order by a) as stops from spans group by doc_id
)
select l.doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(array_to_string(
  case when n_removed is null then w else flatten(list_transform(range(1, len(starts) + 2), lambda j:
    w[(case when j = 1 then 1 else stops[j - 1] end) : (case when j > len(starts) then len(w) else starts[j] - 1 end)])) end, ' ')) as kept_sha256
from lists l left join gone g on g.doc_id = l.doc_id
"""


@query
def op6_suffix_dedup(spark, d):
    return suffix_dedup.remove_repeated_bytes(table(spark, d, "documents"))


ORACLE["op6_suffix_dedup"] = """
with texts as (
  select doc_id, encode(coalesce(text, '')) as h from documents
), windows as (
  select doc_id, i, h[i + 1 : i + 50] as s
  from (select doc_id, h, unnest(range(0, octet_length(h) - 49)) as i from texts)
), firsts as (
  select s, min(doc_id) as first from windows group by s having min(doc_id) < max(doc_id)
), later as (
  select doc_id, i from windows w join firsts f on f.s = w.s and w.doc_id > f.first
), marked as (
  select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 50 then 0 else 1 end as fresh from later
), spans as (
  select doc_id, min(i) as a, max(i) + 50 as b from (
    select doc_id, i, sum(fresh) over (partition by doc_id order by i) as span from marked
  ) group by doc_id, span
), gone as (
  select doc_id, sum(b - a)::bigint as n_removed, count(*) as n_spans, list(a order by a) as starts, list(b order by a) as stops
  from spans group by doc_id
)
select t.doc_id, octet_length(h)::bigint as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(case when n_removed is null then h else unhex(array_to_string(list_transform(range(1, len(starts) + 2), lambda j:
    hex(h[(case when j = 1 then 1 else stops[j - 1] + 1 end) : (case when j > len(starts) then octet_length(h) else starts[j] end)])), '')) end)
    as kept_sha256
from texts t left join gone g on g.doc_id = t.doc_id
"""


@query
def op11_hard_negatives(spark, d):
    rows = table(spark, d, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


ORACLE["op11_hard_negatives"] = """
with whole as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, a.label as anchor_label, c.vec_id, c.label,
    list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i]))::bigint as score
  from whole a join whole c on a.vec_id % 50 = 0 and c.vec_id <> a.vec_id and len(c.v) = len(a.v)
), positives as (
  select * from (
    select *, row_number() over (partition by anchor_id order by score desc, vec_id) as nth from scored where label = anchor_label
  ) where nth <= 5
), negatives as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
    row_number() over (partition by p.anchor_id, p.nth order by n.score desc, n.vec_id)::int as rank
  from positives p join scored n on n.anchor_id = p.anchor_id and n.label <> n.anchor_label
    and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 3
"""


@query
def op12_conversation_repair(spark, d):
    rows = table(spark, d, "conversations")
    return conversation_repair.repair(conversation_repair.damage(rows), rows)


ORACLE["op12_conversation_repair"] = r"""
with recursive ids as (
  select conv_id, row_number() over (order by conv_id)::bigint as c from (select distinct conv_id from conversations)
), crc_table as (
  select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda a, x: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)) as t
), hashed as (
  select i.c, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(
      string_split(coalesce(r.conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda s: unicode(s)::bigint)),
      lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) % 20 as what
  from conversations r join ids i on r.conv_id is not distinct from i.conv_id, crc_table
), damaged as (
  select c, turn, case when what = 4 then 'user' else role end as role,
    case what when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case what when 0 then [] when 3 then [1, 2] else [1] end) as copy
  from hashed
), placed as (
  select c, turn, role, text, substr(role, 1, 1) as initial,
    row_number() over (partition by c order by turn nulls first, role, text, copy) as i,
    row_number() over (partition by c, role, text order by turn nulls first, copy) > 1 as seen,
    regexp_extract(text, '(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as last
  from damaged
), faulty as (
  select *, last = '' as blank, last <> '' and seen as duplicate, last <> '' and not seen and last not in ('.', '!', '?') as truncated,
    lag(initial) over (partition by c order by i) || initial as pair
  from placed
), inserts(st, k, mid, said) as (
  values (0, 0, 0, []::varchar[]), (0, 1, 2, ['user:']), (0, 2, 3, ['user:', 'assistant:']), (1, 0, 1, []), (1, 1, 2, ['user:']),
    (1, 2, 3, ['user:', 'assistant:']), (2, 0, 2, []), (2, 1, 3, ['assistant:']), (2, 2, 2, ['assistant:', 'user:']),
    (3, 0, 3, []), (3, 1, 2, ['user:']), (3, 2, 3, ['user:', 'assistant:'])
), edits as (
  select c, i, st, k + 0 as k, 'D' as letter, mid as to_st, 3 + 2 * k as paid, said from faulty, inserts
  union all
  select c, i, st, k, 'R', case when mid = 2 then 3 else 2 end, 2 + 2 * k + truncated::int,
    list_append(said, case when mid = 2 then 'assistant:' else 'user:' end || text) from faulty, inserts where not blank and not duplicate
  union all
  select c, i, st, k, 'K', case initial when 's' then 1 when 'u' then 2 else 3 end, 2 * k + truncated::int,
    list_append(said, role || ':' || text) from faulty, inserts
  where not blank and not duplicate and (initial = 's' and mid = 0 or initial = 'u' and mid <> 2 or initial = 'a' and mid = 2)
), steps as (
  select c, 0::bigint as i, 0 as st, 0 as cost, '' as audit, []::varchar[] as said from ids
  union all
  select c, i, st, cost, audit, said from (
    select s.c, e.i, e.to_st as st, s.cost + e.paid as cost, s.audit || repeat('I', e.k) || e.letter as audit,
      list_concat(s.said, e.said) as said,
      row_number() over (partition by s.c, e.to_st order by s.cost + e.paid, s.audit || repeat('I', e.k) || e.letter) as nth
    from steps s join edits e on e.c = s.c and e.i = s.i + 1 and e.st = s.st
  ) where nth = 1
), counted as (
  select c, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
    sum(blank::int)::bigint as blank, sum(duplicate::int)::bigint as duplicate, sum(truncated::int)::bigint as truncated,
    sum((pair is not null and pair not in ('su', 'ua', 'au'))::int)::bigint as illegal
  from faulty group by c
), ended as (
  select s.c, s.cost + 2 * k as cost, s.audit || repeat('I', k) as audit, list_concat(s.said, n.said) as said,
    row_number() over (partition by s.c order by s.cost + 2 * k, s.audit || repeat('I', k)) as nth
  from steps s join inserts n on s.st = n.st and (n.mid = 3 or n.mid = 0) left join counted t on t.c = s.c
  where s.i = coalesce(t.n, 0)
)
select i.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, e.cost::bigint as cost, e.audit,
  sha256(array_to_string(e.said, chr(10))) as repaired_sha256
from ids i join ended e on e.c = i.c and nth = 1 left join counted t on t.c = i.c
"""


@query
def op13_simhash_near_dedup(spark, d):
    return simhash.simhash_duplicates(table(spark, d, "documents"))
