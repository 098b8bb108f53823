"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

_LINE_NOTICES = (
    "all rights reserved", "licensed under", "terms of service", "terms of use",
    "privacy policy", "cookie policy", "accept cookies", "uses cookies",
    "subscribe to our newsletter", "sign up for", "enable javascript",
    "click here", "follow us on", "share this", "powered by", "lorem ipsum",
    "permission is hereby granted", "spdx-license-identifier",
)

QUALITY_RULES = r"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
win as (
  select rid, i, array_to_string(w[i:i+7], ' ') as g
  from (select rid, w, unnest(range(1, len(w) - 6)) as i from d where len(w) >= 8)),
rep as (
  select rid, i from (select rid, i, count(*) over (partition by rid, g) as c from win) where c > 1),
cov as (
  select rid, count(distinct p) as n_repeat_words
  from (select rid, unnest(range(i, i + 8)) as p from rep) group by rid),
lines as (
  select rid, unnest(string_split(text, chr(10))) as line from d),
judged as (
  select rid, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as nw,
    len(regexp_extract_all(line, '[|»›·•]')) >= 3
    or len(regexp_extract_all(line, '[!-/:-@\[-`{-~]'))
       > 0.15 * length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))
    or (""" + " or ".join(f"contains(lower(line), '{x}')" for x in _LINE_NOTICES) + r""")
    or (not regexp_matches(line, '[.!?:;…。！？]')
        and len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 40) as bad
  from lines where regexp_matches(line, '[^\x20\x09-\x0D]')),
agg as (
  select rid, count(*) - count(distinct line) as n_dup_lines,
         coalesce(sum(nw) filter (bad), 0)::bigint as lost_words
  from judged group by rid),
base as (
  select d.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
         coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
         coalesce(lost_words, 0)::bigint as lost_words
  from d left join agg using (rid) left join cov using (rid))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
       not (n_words < 20 or 100 * n_repeat_words > 30 * n_words)
         and lost_words <= 0.5 * n_words as kept,
       lost_words
from base
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATION = f"""
with d as (select row_number() over () as rid, doc_id, {_WORDS} as w from documents),
i as (select item_id, {_WORDS} as w from benchmark where item_id is not null),
win as (
  select distinct item_id, k, array_to_string(w[s:s+k-1], ' ') as g
  from (select item_id, w, least(10, len(w)) as k,
               unnest(range(1, len(w) - least(10, len(w)) + 2)) as s from i where len(w) > 0)),
lengths as (select distinct k from win),
dw as (
  select rid, k, s, array_to_string(w[s:s+k-1], ' ') as g
  from (select rid, w, k, unnest(range(1, len(w) - k + 2)) as s from d, lengths where len(w) >= k)),
hit as (select rid, k, s, item_id from dw join win using (k, g)),
pos as (select rid, count(distinct p) as n_hit
        from (select rid, unnest(range(s, s + k)) as p from hit) group by rid),
it as (select rid, list_sort(list(distinct item_id::varchar)) as ids from hit group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(len(ids), 0)::bigint as n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join pos using (rid) left join it using (rid)
"""

JACCARD_JOIN = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct doc_id, array_to_string(w[i:i+4], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
rare as (
  select doc_id, g, row_number() over (partition by doc_id order by c, g) as k
  from s join (select g, count(*) as c from s group by g) using (g)),
pre as (select doc_id, g from rare join n using (doc_id) where k <= n - ceil(0.75 * n) + 1),
cand as (
  select distinct x.doc_id as a, y.doc_id as b
  from pre x join pre y using (g) join n nx on nx.doc_id = x.doc_id join n ny on ny.doc_id = y.doc_id
  where x.doc_id < y.doc_id and 100 * least(nx.n, ny.n) >= 75 * greatest(nx.n, ny.n)),
link as (
  select a, b from (
    select a, b, count(*) as common from cand join s x on x.doc_id = a join s y on y.doc_id = b and y.g = x.g
    group by a, b)
  join n nx on nx.doc_id = a join n ny on ny.doc_id = b
  where 100 * common >= 75 * (nx.n + ny.n - common)),
edge as (select a, b from link union select b, a from link),
reach as (
  select doc_id as root, doc_id from d
  union
  select root, b from reach join edge on edge.a = reach.doc_id where root <= b)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, min(root)::bigint as component_id
from d left join n using (doc_id) join reach using (doc_id)
group by d.doc_id, n.n
"""

HARD_NEGATIVES = """
with v as (
  select row_number() over () as rid, vec_id,
         case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.rid as a, a.vec_id as anchor_id, a.label as anchor_label, b.rid as b, b.vec_id as other_id, b.label,
         list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2]))::bigint as score
  from v a join v b on a.rid <> b.rid
  where a.vec_id % 100 = 0),
pos as (
  select a, anchor_id, anchor_label, other_id as positive_id, score as positive_score, k
  from (select *, row_number() over (partition by a order by score desc, other_id) as k
        from pairs where label = anchor_label) where k <= 5)
select anchor_id::bigint as anchor_id, positive_id::bigint as positive_id, rank::int as rank,
       other_id::bigint as negative_id, positive_score, score as negative_score
from (
  select pos.anchor_id, positive_id, positive_score, other_id, score,
         row_number() over (partition by pos.a, k order by score desc, other_id) as rank
  from pos join pairs on pairs.a = pos.a and pairs.label <> pos.anchor_label
    and 80 * positive_score <= 100 * score and score <= positive_score)
where rank <= 5
"""
