"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

# Written from the contract: the formatted length is counted from the texts
# (marks and one escape character for each escaped character), never read back.
OP1 = r"""
with turns as (
  select conv_id::bigint conv_id, turn::bigint turn, coalesce(role, '') as role,
         coalesce(text, '') as text
  from conversations where conv_id is not null
  union all values (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                   (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
), sized as (
  select *, length(text) - length(replace(text, '\', ''))
    + (length(text) - length(replace(text, '<|im_start|>', ''))) // 12
    + (length(text) - length(replace(text, '<|im_end|>', ''))) // 10 as n_escapes,
    lag(role) over w as before, lead(role) over w as after
  from turns window w as (partition by conv_id order by turn nulls first, role, text)
)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), ''
         order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text)
         filter (where role = 'assistant'), '')) as loss_sha256,
  sum(length(role) + length(text) + n_escapes + 24)::bigint as formatted_chars,
  bool_and(case when after is null then role = 'assistant' else true end
    and case role when 'system' then before is null
      when 'user' then before is null or before in ('system', 'assistant')
      when 'assistant' then before is not null and before in ('user', 'tool')
      when 'tool' then before is not null and before in ('assistant', 'tool')
      else false end) as valid,
  true as mask_agrees
from sized group by conv_id
"""

# The masks are written out: words 0 2 3 5 8 9, words 0 1 2 5 7 9 and words 0 2 6 7 8 9 of ten. Every stretch
# around a hit, of up to ten words more on either side, is tried.
OP3 = r"""
with d as (
  select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from documents where doc_id is not null
), b as (
  select item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from benchmark where item_id is not null
), dw as (
  select doc_id, w, unnest(range(1, len(w) - 8)) as p from d where len(w) >= 10
), bw as (
  select item_id, w, unnest(range(1, len(w) - 8)) as p from b where len(w) >= 10
), ds as (
  select doc_id, p, 1 as mask, [w[p], w[p+2], w[p+3], w[p+5], w[p+8], w[p+9]] as seed from dw
  union all select doc_id, p, 2, [w[p], w[p+1], w[p+2], w[p+5], w[p+7], w[p+9]] from dw
  union all select doc_id, p, 3, [w[p], w[p+2], w[p+6], w[p+7], w[p+8], w[p+9]] from dw
), bs as (
  select item_id, p, 1 as mask, [w[p], w[p+2], w[p+3], w[p+5], w[p+8], w[p+9]] as seed from bw
  union all select item_id, p, 2, [w[p], w[p+1], w[p+2], w[p+5], w[p+7], w[p+9]] from bw
  union all select item_id, p, 3, [w[p], w[p+2], w[p+6], w[p+7], w[p+8], w[p+9]] from bw
), hit as (
  select distinct ds.doc_id, bs.item_id, ds.p, bs.p as q from ds join bs on ds.mask = bs.mask and ds.seed = bs.seed
), words as (
  select hit.doc_id, hit.item_id, hit.p, hit.q, unnest(range(p - 10, p + 20)) as spot, d.w as dw, b.w as bw
  from hit join d using (doc_id) join b using (item_id)
), flag as (
  select doc_id, item_id, p, q, spot - p as k, coalesce(dw[spot] = bw[spot - p + q], false)::int as same
  from words where spot between 1 and len(dw) and spot - p + q between 1 and len(bw)
), upto as (
  select *, sum(same) over (partition by doc_id, item_id, p, q order by k) as n from flag
), best as (
  select x.doc_id, x.item_id, x.p, x.q, max(y.n - x.n + x.same) as agree
  from upto x join upto y using (doc_id, item_id, p, q)
  where x.k <= 0 and y.k >= 9 and y.n - x.n + x.same >= 12 and 100 * (y.n - x.n + x.same) >= 75 * (y.k - x.k + 1)
  group by all
)
select doc_id, item_id, count(*) as n_hits, max(agree)::bigint as most_agree from best group by doc_id, item_id
"""

def _filled(nodes: str, parents: str) -> str:
    """Weighted filling of siblings up to their capacity, as a chain of CTEs over ``nodes``."""
    return f"""
{nodes}_a as (
  select *, capacity / weight as ratio from {nodes} where weight > 0 and capacity > 0
), {nodes}_b as (
  select *, (amount - coalesce(sum(capacity) over (w rows between unbounded preceding and 1 preceding), 0))
      / sum(weight) over (w rows between current row and unbounded following) as lev
  from {nodes}_a window w as (partition by {parents} order by ratio, name)
), {nodes}_c as (
  select *, min(case when ratio > lev then row(ratio, name, lev) end) over (partition by {parents}) as o
  from {nodes}_b
), {nodes}_done as (
  select *, case when ratio <= lev then capacity else o[3] * weight end as given from {nodes}_c
)"""


OP5 = rf"""
with d as (
  select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    case try_cast(regexp_extract(source, '([0-9]+)$', 1) as int) % 4
      when 0 then 'web' when 1 then 'reference' when 2 then 'forum' else 'other' end as domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as tokens
  from documents
), leaf as (
  select domain, lang, source, sum(tokens)::bigint as tokens, (sum(tokens) * 3)::double as capacity
  from d group by all
), n1 as (
  select domain as name, 1 as root, sum(capacity) as capacity,
    (case domain when 'web' then 5 when 'reference' then 3 when 'forum' then 2 else 1 end)::double as weight,
    (select floor(sum(tokens) * 0.8::double) from leaf)::double as amount
  from leaf group by domain
), {_filled("n1", "root")}, n2 as (
  select l.domain, l.lang as name, sum(l.capacity) as capacity,
    (case l.lang when 'en' then 6 when 'de' then 2 when 'fr' then 2 else 1 end)::double as weight,
    any_value(u.given) as amount
  from leaf l join n1_done u on u.name = l.domain group by l.domain, l.lang
), {_filled("n2", "domain")}, n3 as (
  select l.domain, l.lang, l.source as name, l.capacity, 1::double as weight, u.given as amount
  from leaf l join n2_done u on u.domain = l.domain and u.name = l.lang
), {_filled("n3", "domain, lang")}, plan as (
  select l.domain, l.lang, l.source, l.tokens, floor(coalesce(u.given, 0))::bigint as target
  from leaf l left join n3_done u on u.domain = l.domain and u.lang = l.lang and u.name = l.source
), drawn as (
  select d.*, p.target, case when p.tokens > 0 then p.target // p.tokens else 0 end as whole,
    case when p.tokens > 0 then p.target % p.tokens else 0 end as rest
  from d join plan p using (domain, lang, source)
), placed as (
  select *, sum(tokens) over (partition by domain, lang, source
    order by md5('17:' || whole || ':' || coalesce(doc_id::varchar, '')), doc_id) as upto
  from drawn
)
select doc_id, domain, lang, source, tokens, unnest(range(whole))::int as epoch from placed
union all
select doc_id, domain, lang, source, tokens, whole::int from placed where rest > 0 and upto <= rest
"""

OP9 = """
with p as (
  select page_id, url, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest
  from pages
), m as (
  select *, max(page_id) over (partition by payload_digest, payload_bytes) as best from p
)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and best <> page_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and best <> page_id then best end as refers_to, url, true as intact
from m
"""

# Form and cuts from the digest; the output is put together from list slices, the restored text is the text.
OP12 = r"""
with d as (
  select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(doc_id::varchar, '')) as h from documents
), u as (
  select doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as units,
    ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2, ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4
  from d
), c as (
  select *, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) as a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100 then 'plain'
      when h4 % 100 < 50 then 'spm' else 'psm' end as form
  from u
), s as (
  select doc_id, t, len(units) as n, form, array_to_string(units[1:a], '') as p, array_to_string(units[a + 1:b], '') as m,
    array_to_string(units[b + 1:len(units)], '') as s
  from c
)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(p)::bigint end as prefix_chars,
  case when form <> 'plain' then length(m)::bigint end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
    else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256, sha256(t) as restored_sha256
from s
"""

ORACLE_SQL: dict[str, str] = {
    "op1_chat_formatting": OP1,
    "op3_decontamination": OP3,
    "op5_mixing": OP5,
    "op9_warc": OP9,
    "op12_fill_middle": OP12,
}
