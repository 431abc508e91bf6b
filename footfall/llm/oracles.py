"""DuckDB SQL of the queries that SQL can express on whole tables."""

from footfall.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

QUALITY = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (
  select r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from d
),
g as (
  select r, unnest([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)]) as g,
         unnest(range(1, len(ws) - 1)) as i
  from w
),
m as (select r, g, i, count(*) over (partition by r, g) as c from g),
p as (select r, count(distinct x) as n from (select r, unnest([i, i + 1, i + 2]) as x from m where c > 1) group by r),
c as (
  select doc_id, len(ws)::bigint as n_words, coalesce(list_sum([length(x) for x in ws]), 0)::bigint as word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols, len(regexp_extract_all(t, '!'))::bigint as n_exclaims,
         len(list_filter(ws, lambda x: lower(x) in ({_STOP})))::bigint as n_stop_words, len(ls)::bigint as n_lines,
         (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(p.n, 0)::bigint as n_repeat_words
  from w left join p using (r)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed,
       case when n_words < 50 or 100 * n_repeat_words > 50 * n_words then false
            else word_chars / n_words between 2 and 15 and n_symbols / n_words <= 0.3 and n_exclaims / n_words <= 0.5
                 and n_stop_words / n_words >= 0.02 and n_dup_lines / n_lines <= 0.5 end as kept
from c
"""

CHAT = r"""
with r as (
  select conv_id, turn, role, text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
         bool_or(regexp_matches(coalesce(role, '') || chr(10) || coalesce(text, ''), '[<\[]\\*(/?s>|/?INST\])'))
           over (partition by conv_id) as conflict
  from r
),
e as (
  select *, regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') as escaped,
         replace(replace(role, '%', '%25'), chr(10), '%0A') as line
  from t
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
       sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), '')) as loss_sha256,
       sum(length('<s>[INST] ') + length(' [/INST]</s>') + 1
           + length(case when conflict then regexp_replace(line, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g') else line end)
           + length(case when conflict then escaped else text end))::bigint as formatted_chars
from e group by conv_id
"""

LINKED = r"""
with recursive d as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws
  from documents
),
s as (
  select r, doc_id, list_distinct(case when len(ws) = 0 then [] when len(ws) < 4 then [array_to_string(ws, ' ')]
    else [array_to_string(ws[i : i + 3], ' ') for i in range(1, len(ws) - 2)] end) as g
  from d
),
c as (select md5(array_to_string(list_sort(g), chr(10))) as k, any_value(g) as g, min(len(g)) as n from s where len(g) > 0 group by 1),
e as (select k, n, unnest(g) as g from c),
p as (
  select a.k as x, b.k as y from e a join e b on a.g = b.g and a.k < b.k and 100 * a.n >= 85 * b.n and 100 * b.n >= 85 * a.n
  group by a.k, b.k, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
l as (select x, y from p union all select y, x from p),
reached(x, y) as (select k, k from c union select t.x, l.y from reached t join l on t.y = l.x),
own as (select md5(array_to_string(list_sort(g), chr(10))) as k, doc_id, len(g) as n from s),
least as (select t.x as k, min(doc_id) as component_id from reached t join own o on o.k = t.y and o.n > 0 group by t.x)
select o.doc_id, o.n::bigint as n_shingles, case when o.n = 0 then o.doc_id else least.component_id end as component_id
from own o left join least using (k)
"""

# CRC-32 bit by bit: each byte is taken in at the first of its eight steps.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, flatten([[ord(c)::bigint, 0, 0, 0, 0, 0, 0, 0] for c in string_split({0}, '')])),
  lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384::bigint)), 4294967295)"""

REPAIR = rf"""
with recursive d as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         {_CRC32.format("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind
  from conversations
),
m as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, kind
  from d where kind <> 0
  union all select conv_id, turn, role, text, kind from d where kind = 3
),
n0 as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from m),
o as (select *, row_number() over (partition by conv_id, role, text order by i) as seen from n0),
f as (
  select conv_id, i, turn, role, text, substr(role, 1, 1) as c,
         case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'b' when seen > 1 then 'd'
              when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 't' else '' end as fault
  from o
),
-- s: 0 nothing yet, 1 after system, 2 after user, 3 after assistant; p: state, cost, audit and text with up to two inserts
w as (
  select conv_id, 1::bigint as i, 0 as s, 0::bigint as cost, '' as audit, '' as body from f where i = 1
  union all
  select conv_id, i + 1, s, min(cost), arg_min(audit, (cost, audit)), arg_min(body, (cost, audit))
  from (
    select p.conv_id, p.i, x.s, p.cost + x.cost as cost, p.audit || x.audit as audit, p.body || x.body as body
    from (
      select w.conv_id, w.i, unnest([
        {{s: w.s, cost: w.cost, audit: w.audit, body: w.body}},
        {{s: case when w.s = 2 then 3 else 2 end, cost: w.cost + 5, audit: w.audit || 'I',
         body: w.body || chr(10) || case when w.s = 2 then 'assistant:' else 'user:' end}},
        {{s: case when w.s = 2 then 2 else 3 end, cost: w.cost + 10, audit: w.audit || 'II',
         body: w.body || case when w.s = 2 then chr(10) || 'assistant:' || chr(10) || 'user:' else chr(10) || 'user:' || chr(10) || 'assistant:' end}}
      ], recursive := true) from w
    ) p(conv_id, i, s, cost, audit, body)
    join f on f.conv_id is not distinct from p.conv_id and f.i = p.i,
    lateral (
      select p.s as s, 2 as cost, 'D' as audit, '' as body
      union all
      select case f.c when 's' then 1 when 'u' then 2 else 3 end, case f.fault when 't' then 5 else 0 end, 'K', chr(10) || f.role || ':' || f.text
      where f.fault not in ('b', 'd') and ((f.c = 's' and p.s = 0) or (f.c = 'u' and p.s <> 2) or (f.c = 'a' and p.s = 2))
      union all
      select case p.s when 2 then 3 else 2 end, case f.fault when 't' then 6 else 1 end, 'R',
             chr(10) || case p.s when 2 then 'assistant:' else 'user:' end || f.text
      where f.fault not in ('b', 'd')
    ) x
  ) group by conv_id, i, s
),
n as (select conv_id, max(i) as n from f group by 1),
last as (
  select w.conv_id, min(cost + e) as cost, arg_min(audit || a, (cost + e, audit || a)) as audit, arg_min(body || b, (cost + e, audit || a)) as body
  from w join n on n.conv_id is not distinct from w.conv_id and w.i = n.n + 1
  join (values (0, 0, '', ''), (1, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (2, 5, 'I', chr(10) || 'assistant:'), (3, 0, '', '')) v(s, e, a, b)
    on v.s = w.s
  group by w.conv_id
),
k as (
  select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count(*) filter (fault = 'b') as blank,
         count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated from f group by 1
),
j as (
  select conv_id, count(*) filter (p is not null and p || c not in ('su', 'ua', 'au')) as illegal
  from (select conv_id, c, lag(c) over (partition by conv_id order by i) as p from f) group by 1
)
select a.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost,
       coalesce(audit, '') as audit, sha256(coalesce(substr(body, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) a
left join k on k.conv_id is not distinct from a.conv_id
left join j on j.conv_id is not distinct from a.conv_id
left join last on last.conv_id is not distinct from a.conv_id
"""

SQL = {"op12_conversation_repair": REPAIR, "op11_ngram_join": LINKED, "op4_quality_rules": QUALITY, "op6_chat_format": CHAT}
