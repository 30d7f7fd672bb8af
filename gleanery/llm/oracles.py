"""SQL that must give the rows of the queries that SQL can express."""

from __future__ import annotations

# Fixed value: the words of the decontamination contract.
_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP3 = rf"""
with docs as (select row_number() over () as r, doc_id, {_WORDS} as ws from documents),
items as (select cast(item_id as varchar) as item, {_WORDS} as ws from benchmark),
phrases as (
  select distinct item, least(len(ws), 10) as n, array_to_string(ws[p:p + 9], ' ') as phrase
  from (select item, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as p from items where len(ws) > 0)),
places as (
  select r, n, p, array_to_string(ws[p:p + n - 1], ' ') as phrase
  from (select r, n, ws, unnest(range(1, len(ws) - n + 2)) as p from docs, (select distinct n from phrases))),
found as (select r, item, p, n from places join phrases using (n, phrase)),
hits as (select r, count(distinct q) as n_hit from (select r, unnest(range(p, p + n)) as q from found) group by r),
named as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct r, item from found) group by r)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hits using (r) left join named using (r)
"""

OP5 = r"""
with docs as (select doc_id, text, string_split(coalesce(text, ''), chr(10)) as lines from documents),
split as (
  select doc_id, text, p - 1 as line_no,
    list_transform(list_filter(regexp_split_to_array(lines[p], '[\x20\x09\x0B-\x0D]+'), lambda w: w <> ''),
      lambda w: case when regexp_matches(w, '[0-9]') then '<*>' else w end) as ws
  from (select *, unnest(range(1, len(lines) + 1)) as p from docs)),
lines as materialized (
  select *, len(ws) as n, array_to_string(ws, ' ') as line, len(ws) || ' ' || array_to_string(ws[1:3], ' ') as leaf from split where len(ws) > 0),
forms as (select leaf, line, any_value(ws) as ws, count(*) as n, count(distinct (doc_id, text)) as docs from lines where n >= 6 group by leaf, line),
leaves as (select leaf, count(*) as forms from forms group by leaf having sum(n) >= 3 and count(*) > 1),
words as materialized (
  select leaf, line, ws, forms, docs, p, ws[p] as w from (select *, unnest(range(1, len(ws) + 1)) as p from forms join leaves using (leaf))),
common as (select leaf, p, w from words group by leaf, forms, p, w having count(*) * 2 > forms),
placed as (
  select leaf, line, list(coalesce(c.w, '<*>') order by p) as template, count(*) filter (where words.w = coalesce(c.w, '<*>')) as alike
  from words left join common c using (leaf, p) group by leaf, line),
general as materialized (select line, 'g' || leaf || chr(10) || array_to_string(template, ' ') as template from placed
  where alike >= 0.6 * len(template) and leaf in (select leaf from common)),
support as (select leaf, p, w, sum(docs) as support from words group by leaf, p, w having sum(docs) >= 3),
held as (
  select leaf, line, len(ws) as n, list(struct_pack(p, w, s := support) order by p) as held, list(support order by support desc) as supports
  from words join support using (leaf, p, w) where line not in (select line from general) group by leaf, line, ws),
family as (
  select line, 'f' || leaf || chr(10) || list_transform(list_filter(held, lambda h: h.s * 2 >= supports[cast(ceil(0.6 * n) as int)]), lambda h: (h.p, h.w))::varchar as template
  from held where len(held) >= ceil(0.6 * n)),
named as materialized (
  select doc_id, text, line_no, n, line, coalesce(g.template, f.template, 't' || line) as template
  from lines left join general g using (line) left join family f using (line)),
frequent as (
  select template, n, min(doc_id) as first, count(*) as docs, min(line) as line from (select distinct template, n, doc_id, text, case when n < 6 then line end as line from named)
  group by template, n having count(*) >= case when n >= 12 then 2 when n >= 6 then 3 else 3 * pow(2, 6 - n) end),
short as (select line, n, count(*) as uses from lines where n < 6 group by line, n),
each as (select n, uses, unnest(string_split(line, ' ')) as w from short),
uses as (select n, w, sum(uses) as uses from each where n > 1 group by n, w union all select 1, w, sum(uses) from each group by w),
lengths as (select n, sum(uses) as lines, case when n > 1 then sum(n * uses) else (select sum(uses) from each) end as every from short group by n),
chances as (
  select template, any_value(docs) as docs, any_value(lines) * exp(sum(ln(uses.uses / every))) as chance
  from (select template, n, docs, unnest(string_split(line, ' ')) as w from frequent where n < 6) f join uses using (n, w) join lengths using (n) group by template),
recurring as (
  select template, first from frequent where n >= 6 or template in (select template from chances where docs > chance + 4 * sqrt(chance))),
gone as (select distinct doc_id, text, line_no from named join recurring using (template) where doc_id <> first),
dropped as (select doc_id, text, list(line_no) as gone from gone group by doc_id, text)
select doc_id, len(lines)::int as n_lines, coalesce(len(gone), 0)::int as n_dropped,
  case when gone is null then text else array_to_string(
    list_transform(list_filter(range(0, len(lines)), lambda i: not list_contains(gone, i)), lambda i: lines[i + 1]), chr(10)) end as text
from docs left join dropped using (doc_id, text)
"""

OP7 = r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked as (
  select *, '<turn>' || replace(replace(replace(role, '\', '\b'), '<', '\l'), chr(10), '\n') || chr(10)
    || replace(replace(text, '\', '\b'), '<', '\l') || '</turn>' || chr(10) as piece from said),
sized as (select *, cast(ceil(strlen(piece) / 4.0) as bigint) as tokens from marked),
placed as (
  select *, row_number() over w as pos, sum(tokens) over w as fin, sum((tokens > 768)::int) over w as longs
  from sized
  window w as (partition by conv_id order by turn nulls first, role, text rows between unbounded preceding and current row)),
keyed as (
  select *, fin - tokens as start, longs || '/' || (tokens > 768)::int || '/' || (fin - 1) // 768 as key,
    pos = 1 and role = 'system' as leads from placed),
wins as (select conv_id, key, min(start) as first_start, min(pos) as first_turn from keyed group by all),
members as (
  select conv_id, key, length(piece) as chars from keyed
  union all
  select k.conv_id, w.key, length(piece) from keyed k join wins w
    on k.conv_id = w.conv_id and not leads and first_start between fin and start + 256
  union all
  select k.conv_id, w.key, length(piece) from keyed k join wins w on k.conv_id = w.conv_id and leads and first_turn > 1),
formatted as (select conv_id, sum(chars) as formatted_chars from members group by all),
whole as (
  select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '') as loss
  from said group by all)
select conv_id, n_turns, turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
  cast(formatted_chars as bigint) as formatted_chars
from whole join formatted using (conv_id)
"""

OP9 = r"""
with docs as (
  select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents),
split as (
  select *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') as ws,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines from docs),
grams as (
  select r, p, array_to_string(ws[p:p + 7], ' ') as g
  from (select r, ws, unnest(range(1, len(ws) - 6)) as p from split)),
repeats as (select r, p from (select r, p, count(*) over (partition by r, g) as n from grams) where n > 1),
covered as (
  select r, count(distinct q) as n_repeat_words from (select r, unnest(range(p, p + 8)) as q from repeats) group by r),
base as (
  select doc_id, source, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words
  from split left join covered using (r)),
judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from base),
hosts as (select source, count(*) as n, sum(base_failed::int) as f from judged group by source),
prior as (
  select sum(f) / sum(n) as m, sum(f * f / n) / sum(n) - pow(sum(f) / sum(n), 2) as spread, (count(*) - 1) / sum(n) as sampling,
    1 - sum(n * n) / pow(sum(n), 2) - (count(*) - 1) / sum(n) as weight from (select n::double as n, f::double as f from hosts)),
shares as (
  select m, case when m * (1 - m) > 0 and weight > 0 then (spread - m * (1 - m) * sampling) / (m * (1 - m) * weight) else 0 end as share from prior),
fitted as (select m, case when share > 0 then least(greatest(1 / share - 1, 1), 1e6) else 1e6 end as k from shares),
verdicts as (select source, (f + m * k) / (n + k) > 0.5 as host_failed from hosts, fitted)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not host_failed as kept
from judged j join verdicts v on j.source is not distinct from v.source
"""

def _nearest(i: int) -> str:
    return f"""
assigned{i} as (
  select r, arg_min(cluster, d * 64 + cluster) as cluster, min(d) as distance from (
    select r, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
    from kept, centroids{i}) group by r),"""


def _moved(i: int) -> str:
    return f"""
centroids{i + 1} as (
  select cluster, coalesce(m, c) as c from centroids{i} left join (
    select cluster, list(m order by p) as m from (
      select cluster, p, floor(sum(v[p])::double / count(*))::bigint as m
      from (select cluster, v, unnest(range(1, 65)) as p from kept join assigned{i} using (r)) group by cluster, p)
    group by cluster) using (cluster)),"""


OP11 = f"""
with whole as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
kept as (select r, vec_id, list_transform(e, lambda x: floor(256 * x)::bigint) as v from whole),
centroids0 as (
  select row_number() over (order by sha256('2:' || vec_id)) - 1 as cluster, v as c from kept
  order by sha256('2:' || vec_id) limit 40),{"".join(_nearest(i) + _moved(i) for i in range(5))}{_nearest(5)}
inertias as (select cluster, sum(distance)::bigint as cluster_inertia from assigned5 group by cluster)
select vec_id, cluster::int as cluster, distance, cluster_inertia, (select sum(distance)::bigint from assigned5) as inertia,
  sha256(array_to_string(c, ',')) as centroid_sha256
from kept join assigned5 using (r) join inertias using (cluster) join centroids5 using (cluster)
"""

# Costs in seven digits before the audit, so that the least string is the cheapest and then the first.
def _more(best: str, cost: str, letter: str) -> str:
    return f"(lpad(cast(cast(left({best}, 7) as int) + {cost} as varchar), 7, '0') || substr({best}, 8) || '{letter}')"


OP12 = rf"""
with recursive damaged as (
  select *, xor(list_reduce([4294967295::bigint] || list_transform(range(1, length(k) + 1), lambda i: ascii(k[i])::bigint),
    lambda c, b: list_reduce([xor(c, b)] || range(0, 8),
      lambda x, j: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) % 20 as deal
  from (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
      coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations)),
kept as (
  select conv_id, turn, case when deal = 4 then 'user' else role end as role,
    case when deal = 1 then '' when deal = 2 then translate(text, '.!?', '') else text end as text
  from (select *, unnest(case when deal = 3 then [1, 2] else [1] end) from damaged where deal <> 0)),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(length(role) || ':' || role || text)) as i,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as final, left(role, 1) as ini from kept),
coded as (
  select *, case when final = '' then 'blank' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
    when final not in ('.', '!', '?') then 'truncated' else 'none' end as fault from placed),
paths as (
  select conv_id, 0::bigint as i, '0000000' as z, null::varchar as s, null::varchar as u, null::varchar as a from (select distinct conv_id from coded)
  union all
  select conv_id, i, {_more("z", "4", "D")},
    least({_more("s", "4", "D")}, case when stays and ini = 's' then {_more("z", "t", "K")} end),
    least({_more("u1", "4", "D")},
      case when stays and ini = 'u' then least({_more("z", "t", "K")}, {_more("s", "t", "K")}, {_more("a1", "t", "K")}) end,
      case when stays then least({_more("z", "3 + t", "R")}, {_more("s", "3 + t", "R")}, {_more("a1", "3 + t", "R")}) end),
    least({_more("a1", "4", "D")},
      case when stays and ini = 'a' then {_more("u1", "t", "K")} end,
      case when stays then {_more("u1", "3 + t", "R")} end)
  from (
    select n.conv_id, c.i, z, s, u1, a1, ini, fault in ('none', 'truncated') as stays, case when fault = 'truncated' then 3 else 0 end as t
    from (select *, least(a, {_more("u1", "3", "I")}) as a1 from (
      select *, least(u, {_more("z", "3", "I")}, {_more("s", "3", "I")}, {_more("a", "3", "I")}) as u1 from paths)) n
    join coded c on c.conv_id is not distinct from n.conv_id and c.i = n.i + 1)),
ends as (
  select conv_id, arg_max(z, i) as z, arg_max(s, i) as s, arg_max(u, i) as u, arg_max(a, i) as a from (
    select conv_id, i, coalesce(z, 'x') as z, coalesce(s, 'x') as s, coalesce(u, 'x') as u, coalesce(a, 'x') as a from paths) group by conv_id),
known as (select conv_id, z, nullif(s, 'x') as s, nullif(u, 'x') as u, nullif(a, 'x') as a from ends),
best as (
  select conv_id, least(z, a, {_more("u1", "3", "I")}) as best from (
    select *, least(u, {_more("z", "3", "I")}, {_more("s", "3", "I")}, {_more("a", "3", "I")}) as u1 from known)),
edits as (
  select conv_id, p, e, sum((e <> 'I')::int) over w as i, sum((e <> 'D')::int) over w as n from (
    select conv_id, unnest(range(8, length(best) + 1)) as p, substr(best, p, 1) as e from best)
  window w as (partition by conv_id order by p)),
spoken as (
  select e.conv_id, e.p, e.e, e.n, c.role, case when e.e = 'I' then '' else c.text end as text,
    max((e.n = 1 and e.e = 'K' and c.ini = 's')::int) over (partition by e.conv_id) as led
  from edits e left join coded c on c.conv_id is not distinct from e.conv_id and c.i = e.i and e.e <> 'I' where e.e <> 'D'),
repaired as (
  select conv_id, sha256(string_agg(case when e = 'K' then role when (n - led) % 2 = 1 then 'user' else 'assistant' end
    || ':' || text, chr(10) order by p)) as digest from spoken group by conv_id),
counted as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (ini || after not in ('su', 'ua', 'au')) as illegal
  from (select *, lead(ini) over (partition by conv_id order by i) as after from coded) group by conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cast(left(best, 7) as bigint), 0) as cost,
  coalesce(substr(best, 8), '') as audit, coalesce(digest, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counted c on c.conv_id is not distinct from o.conv_id
left join best b on b.conv_id is not distinct from o.conv_id
left join repaired r on r.conv_id is not distinct from o.conv_id
"""

ORACLES = {
    "op3_decontaminate": OP3,
    "op5_template_lines": OP5,
    "op7_chat_windows": OP7,
    "op9_host_rules": OP9,
    "op11_clustering": OP11,
    "op12_conversation_repair": OP12,
}
