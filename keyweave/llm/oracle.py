"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLE_SQL: dict[str, str] = {
    "op1_topk_search": """
with v as (
  select vec_id, min(list_transform(embedding, lambda x: floor(256 * x::double)::bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
  group by vec_id),
s as (
  select q.vec_id as query_id, c.vec_id as vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))
           ::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
r as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int
           as rank, vec_id, score
  from s)
select query_id, rank, vec_id, score from r where rank <= 5
""",
    "op6_warc_revisits": r"""
with a as (
  select page_id, html, trim(url, ' ') as url, strlen(html) as size, length(url) as letters,
         regexp_replace(trim(url, ' '), '#.*$', '') as plain
  from pages),
b as (select *, lower(regexp_extract(plain, '^([A-Za-z][A-Za-z0-9+.-]*://)?([^/?]*)')) as head
      from a),
c as (select *, substr(plain, length(head) + 1) as rest,
             regexp_replace(regexp_replace(regexp_replace(head, '^https?://', ''),
                                           '^www\.', ''), ':(80|443)$', '') as host from b),
d as (select *, regexp_replace(regexp_replace(rest, '\?.*$', ''), '/+$', '') as path,
             list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'),
               lambda p: p <> '' and split_part(p, '=', 1) not in (
                 'utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'ref',
                 'fbclid', 'gclid'))) as params from c),
e as (
  select page_id, host || path || case when len(params) > 0
           then '?' || array_to_string(params, '&') else '' end as canonical_url,
         md5(html) as digest, size, letters, (page_id * 7919) % 100000 as first,
         (page_id * 7919) % 100000 + 1 + (coalesce(size, 0) * 31) % 172800 as again,
         case when letters % 4 <> 0 then '"' || md5(html) || '"' end as etag,
         case when letters % 3 <> 0 then (1699000000 + size)::varchar end as modified
  from d),
r as (
  select q.page_id * 2 + 1 as record_id, q.canonical_url, q.again, q.etag, q.modified, q.letters,
         s.page_id as sid, s.first as sfirst, s.etag as setag, s.modified as smod,
         s.digest as sdigest, s.size as ssize,
         row_number() over (partition by q.page_id order by s.first desc, s.page_id desc) as k
  from e q left join e s on s.canonical_url = q.canonical_url and s.first < q.again),
o as (
  select *, case when sid is null then 'no response'
                 when etag is not null and setag is not null
                   then case when etag = setag then 'resolved' else 'changed' end
                 when modified is not null and smod is not null
                   then case when modified = smod then 'resolved' else 'changed' end
                 else 'unverified' end as outcome
  from r where k = 1),
g as (select *, outcome in ('resolved', 'unverified') as good from o)
select record_id, canonical_url, (1700000000 + again)::bigint as date_s, outcome,
       case when good then sid * 2 end as source_id,
       case when good then (1700000000 + sfirst)::bigint end as source_date_s,
       case when good then sdigest end as payload_digest,
       case when good then ssize::bigint end as payload_length,
       case when good then array_to_string(list_filter([
         'cache-control: max-age=' || coalesce(letters, 0), 'content-type: text/html',
         'etag: ' || coalesce(etag, setag), 'last-modified: ' || smod],
         lambda x: x is not null), chr(10)) end as headers
from g
""",
    "op7_decontaminate": rf"""
with d as (select row_number() over () as rid, doc_id, {WORDS} as w from documents),
i as (select item_id, {WORDS} as w from benchmark where item_id is not null),
iw as (
  select distinct item_id, least(13, len(w)) as n,
         array_to_string(w[k:k + least(13, len(w)) - 1], ' ') as win
  from (select item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) as k
        from i where len(w) > 0)),
dw as (
  select rid, k, n, array_to_string(w[k:k + n - 1], ' ') as win
  from (select rid, w, n, unnest(range(1, len(w) - n + 2)) as k
        from d cross join (select distinct n from iw) where len(w) >= n)),
h as (select rid, k, dw.n, item_id from dw join iw on iw.n = dw.n and iw.win = dw.win),
p as (select rid, count(distinct pos) as n_hit
      from (select rid, unnest(range(k, k + n)) as pos from h) group by rid),
t as (select rid, count(distinct item_id) as n_items,
             string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items
      from h group by rid)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join p using (rid) left join t using (rid)
""",
    "op11_prefix_trie": r"""
with t as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''),
                            md5(coalesce(text, ''))) as pos
  from conversations where conv_id is not null),
k as (
  select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
           lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)) as tab),
v as (select c, count(*) as n, c - c % 5 as base from t group by c),
w as (
  select v.c, v.n, v.base, coalesce(b.n, 0) as base_n,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(v.c::varchar, ''),
               lambda x: ascii(x)::bigint)),
             lambda x, y: xor(x >> 8, tab[(xor(x, y) & 255) + 1])), 4294967295) % 9 as h
  from v cross join k left join v b on b.c = v.base),
r as (
  select t.c, t.pos, t.role, t.text from t join w using (c) where w.base = w.c
  union all
  select t.c, t.pos - h + least(h, base_n), t.role, t.text
  from t join w using (c) where w.base <> w.c and t.pos > h
  union all
  select w.c, t.pos, t.role, t.text from w join t on t.c = w.base and t.pos <= w.h
  where w.base <> w.c),
s as (
  select c, coalesce(q, []) as q from w left join (
    select c, list({'role': role, 'text': text} order by pos) as q from r group by c) using (c)),
p as (select c, len(q) as n, d, q[1:d] as pre
      from (select c, q, unnest(range(0, len(q) + 1)) as d from s)),
g as (
  select d, pre, min(c) as conv_id, count(*) as n_convs,
         coalesce(string_agg(c::varchar, ',' order by c) filter (where n = d), '') as ends
  from p group by d, pre),
kids as (select d - 1 as d, pre[1:d - 1] as pre, count(*) as n_children from g where d > 0
         group by all),
f as (
  select g.*, m.conv_id as parent_conv_id, coalesce(n_children, 0) as n_children,
         case when g.d = 0 then 0 else (g.n_convs - 1) * strlen(g.pre[g.d].text) end as own
  from g left join kids on kids.d = g.d and kids.pre = g.pre
  left join g m on m.d = g.d - 1 and m.pre = g.pre[1:g.d - 1]),
tot as (
  select a as d, pre[1:a] as pre, count_if(n_children = 0)::bigint as n_leaves,
         sum(own)::bigint as saved_tokens
  from (select *, unnest(range(0, d + 1)) as a from f) group by all)
select conv_id, f.d as depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
       sha256(ends) as ends_sha256
from f join tot on tot.d = f.d and tot.pre = f.pre
""",
    "op12_kronecker_negatives": """
with e as (
  select row_number() over () as rid, vec_id,
         case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.rid, a.vec_id as anchor_id, c.vec_id, c.label = a.label as same,
         coalesce(list_sum(list_transform(list_zip(a.v, c.v),
           lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0)::bigint as score
  from e a join e c on a.vec_id % 100 = 0 and c.rid <> a.rid),
p as (
  select rid, anchor_id, vec_id as positive_id, score as positive_score,
         row_number() over (partition by rid order by score desc, vec_id) as r
  from s where same qualify r <= 5),
n as (
  select p.anchor_id, p.positive_id, p.positive_score, s.vec_id as negative_id,
         s.score as negative_score,
         (row_number() over (partition by p.rid, p.r order by s.score desc, s.vec_id))::int as rank
  from p join s on s.rid = p.rid and not s.same
    and 80 * p.positive_score <= 100 * s.score and 100 * s.score <= 100 * p.positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score
from n where rank <= 5
""",
    "op13_one_bit_codes": """
with e as (
  select row_number() over () as rid, vec_id, list_transform(embedding, lambda x: x::double) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
s as (
  select q.rid, q.vec_id as query_id, c.vec_id,
         list_reduce(list_prepend(0.0::double, list_transform(list_zip(q.v, c.v),
           lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), lambda x, y: x + y) as score
  from e q join e c on q.vec_id % 20 = 0 and c.rid <> q.rid)
select query_id, (row_number() over (partition by rid order by score desc, vec_id))::int as rank,
       vec_id, score
from s qualify rank <= 20
""",
}
