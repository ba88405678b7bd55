"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_WARC = """
with p as (
  select page_id, coalesce(html, '') as html from pages
), d as (
  select page_id, octet_length(encode(html)) as payload_bytes, sha1(html) as hex from p
), f as (
  select *, min(page_id) over (partition by hex) as first_id,
         row_number() over (partition by hex order by page_id nulls last) as rn
  from d
)
select page_id, payload_bytes::bigint as payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + (((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::bigint) >> (15 - 5 * (i % 4))) & 31)::integer, 1)),
         '') as payload_digest,
       case when rn = 1 then 'response' else 'revisit' end as record_type,
       case when rn > 1 then first_id end as refers_to
from f
"""

_DECONTAMINATION = r"""
with dw as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), iw as (
  select item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), pat as (
  select item_id, least(len(w), 10) as n, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i, w
  from iw where len(w) > 0
), win as (
  select distinct item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as s from pat
), lens as (
  select distinct n from win
), occ as (
  select r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') as s
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, lens where len(w) >= n)
), hit as (
  select distinct o.r, o.n, o.i, win.item_id from occ o join win on o.n = win.n and o.s = win.s
), hw as (
  select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hit) group by r
), hi as (
  select r, count(distinct item_id) as n_items,
         string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items
  from hit group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join hw on dw.r = hw.r left join hi on dw.r = hi.r
"""


_TOPK = """
with v as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as x
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.r, q.vec_id as query_id, c.vec_id, case when len(q.x) = 0 or len(c.x) = 0 then 0 else list_inner_product(q.x, c.x) end::bigint as score, c.r as cr
  from v q join v c on q.r <> c.r where q.vec_id % 20 = 0
), t as (
  select *, row_number() over (partition by r order by score desc, vec_id, cr) as rank from s
)
select query_id, rank::integer as rank, vec_id, score from t where rank <= 20
"""


_TRIE = """
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
         md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as id
  from conversations where conv_id is not null
), own as (
  select conv_id, list(id order by turn nulls first, id) as ids, list(length(text)::bigint order by turn nulls first, id) as chars
  from t group by conv_id
), h as (
  -- crc32 of the decimal id, bit by bit
  select conv_id, list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(conv_id::varchar) + 1),
           lambda i: ascii(substr(conv_id::varchar, i::integer, 1))::bigint)),
           lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda v, k:
             case when v & 1 = 1 then xor(v >> 1, 3988292384::bigint) else v >> 1 end)) as crc
  from own
), r as (
  select o.conv_id,
         list_concat(coalesce(list_slice(a.ids, 1, n), []), list_slice(o.ids, n + 1, len(o.ids))) as ids,
         list_concat(coalesce(list_slice(a.chars, 1, n), []), list_slice(o.chars, n + 1, len(o.chars))) as chars
  from own o join (select conv_id, (xor(crc, 4294967295::bigint) % 6)::integer as n from h) using (conv_id)
  left join own a on a.conv_id = o.conv_id - o.conv_id % 100
), p as (
  select conv_id, d, array_to_string(list_slice(ids, 1, d), '') as node, array_to_string(list_slice(ids, 1, d - 1), '') as parent,
         case when d = 0 then 0 else chars[d] end as chars, len(ids) = d as ends
  from (select *, unnest(range(0, len(ids) + 1)) as d from r)
), n as (
  select d, node, any_value(parent) as parent, any_value(chars) as chars, min(conv_id) as conv_id, count(*) as n_convs,
         string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends) as ends
  from p group by d, node
), kids as (
  select parent, d - 1 as d, count(*) as n_children from n where d > 0 group by parent, d
), f as (
  select n.*, coalesce(k.n_children, 0) as n_children from n left join kids k on k.parent = n.node and k.d = n.d
), below as (
  select substr(node, 1, 32 * a) as top, a as d, count(*) filter (where n_children = 0) as n_leaves,
         sum((n_convs - 1) * chars) as saved_tokens
  from (select *, unnest(range(0, d + 1)) as a from f) group by 1, 2
)
select f.conv_id, f.d as depth, u.conv_id as parent_conv_id, f.n_convs, f.n_children, b.n_leaves::bigint as n_leaves,
       b.saved_tokens::bigint as saved_tokens, sha256(coalesce(f.ends, '')) as ends_sha256
from f join below b on b.top = f.node and b.d = f.d left join f u on f.d > 0 and u.node = f.parent and u.d = f.d - 1
"""

# Links with absolute targets and targets that start with a slash; others need the rules of URL resolution.
_URLFILTER = r"""
with recursive rules(verdict, host, path) as (
  values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), tags as (
  select url, unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>', '', 'g'), '(?i)<(?:link|meta)\s[^>]*>')) as tag
  from pages where url like '%://%'
), found as (
  select url, case when regexp_matches(tag, '(?i)^<link.*\srel\s*=\s*["'']?(?:[^"''>]*\s)?canonical[\s"''/>]')
                   then regexp_extract(tag, '(?i)\shref\s*=\s*["'']?([^"''\s>]+)', 1)
                   when regexp_matches(tag, '(?i)^<meta.*\shttp-equiv\s*=\s*["'']?refresh')
                   then regexp_extract(tag, '(?i)url\s*=\s*[''"]?([^''"\s>]+)', 1) end as target
  from tags
), links as (
  select url, case when target like '//%' then split_part(url, '://', 1) || ':' || target
                   when target like '/%' then regexp_extract(url, '^.*?://[^/?#]*') || target else target end as target
  from found where target <> ''
), urls as (
  select url from pages union select url from links union select target from links
), parts as (
  select url, case when url like '%://%' then substr(url, strpos(url, '://') + 3) else '' end as rest from urls
), split as (
  select url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path, regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) as query
  from parts
), judged as (
  select s.url, any_value(s.host) as host, any_value(s.path) as path,
         any_value(s.host || case when s.path = '' then '/' else s.path end || s.query) as alias,
         arg_max(r.host || r.path, length(r.host || r.path)) as rule, arg_max(r.verdict, length(r.host || r.path)) as ruling
  from split s left join rules r on (s.host = r.host or ends_with(s.host, '.' || r.host)) and starts_with(s.path, r.path)
  group by s.url
), edges as (
  select a.alias as x, b.alias as y from links l join judged a on a.url = l.url join judged b on b.url = l.target
  where l.target like '%://%'
), near as (
  select x, x as y from edges union select y, y from edges
  union select n.x, case when e.x = n.y then e.y else e.x end from near n join edges e on e.x = n.y or e.y = n.y
), aliases as (
  select n.x, bool_or(j.ruling = 'block') and not coalesce(bool_or(j.ruling = 'allow'), false) as blocked
  from near n join judged j on j.alias = n.y group by n.x
)
select p.page_id, coalesce(j.host, '') as host, coalesce(j.path, '') as path, j.rule,
       coalesce(j.ruling, case when a.blocked and p.url like '%://%' then 'block' else 'allow' end) as verdict
from pages p left join judged j on j.url = p.url left join aliases a on a.x = j.alias
"""


def _sharding(limit: int, bits: int = 52, depth: int = 30) -> str:
    """Extendible hashing as one statement; right while no two keys agree in ``depth`` bits."""
    return f"""
with d as (
  select doc_id, octet_length(encode(coalesce(text, '')))::bigint as n_bytes,
         md5(coalesce(doc_id::varchar, '') || ':' || coalesce(md5(text), '')) as h from documents
), k as (
  select doc_id, n_bytes, h, lpad(bin(('0x' || substr(h, 1, 13))::bigint), {bits}, '0') as key from d
), small as (
  select * from k where n_bytes <= {limit}
), pre as (
  select doc_id, h, n_bytes, b as depth, substr(key, 1, b::integer) as shard
  from small, (select unnest(range(0, {depth + 1})) as b)
), sums as (
  select shard, sum(n_bytes)::bigint as shard_bytes from pre group by shard having sum(n_bytes) <= {limit}
), best as (
  select doc_id, h, min(depth) as depth from pre join sums using (shard) group by all
)
select pre.doc_id, pre.n_bytes, pre.shard, pre.depth::integer as depth, sums.shard_bytes, true as fits
from pre join best on pre.h = best.h and pre.depth = best.depth join sums on pre.shard = sums.shard
"""


def oracle_sql() -> dict[str, str]:
    from tripflow.llm import sharding
    return {"op1_warc": _WARC, "op5_topk": _TOPK, "op8_decontamination": _DECONTAMINATION,
            "op10_sharding": _sharding(sharding.SHARD_BYTES), "op11_trie": _TRIE, "op12_urlfilter": _URLFILTER}
