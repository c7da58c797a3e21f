"""The results of this package's queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_CHAT = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized as (
  select *,
    length(replace(replace(replace(role, '~', '~0'), '<|', '~1'), '|>', '~2'))
    + length(replace(replace(replace(text, '~', '~0'), '<|', '~1'), '|>', '~2')) + 11 as shown,
    role = 'assistant' as trained
  from rows),
placed as (
  select *,
    sum(shown) over whole as upto,
    row_number() over whole = count(*) over (partition by conv_id) as last
  from sized
  window whole as (partition by conv_id order by turn, role, text rows unbounded preceding))
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  length(coalesce(string_agg(text, '' order by turn, text) filter (trained), ''))::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, text) filter (trained), '')) as loss_sha256,
  coalesce(sum(upto) filter (trained or last), 0)::bigint as formatted_chars,
  count(*) filter (trained or last)::bigint as n_examples
from placed group by conv_id
"""

_HITS = r"""
with items as (
  select item_id::varchar as item, regexp_extract_all(lower_ascii, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from (select item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_ascii
        from benchmark where text is not null)),
windows as (
  select distinct item, least(10, len(w)) as size,
    array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as phrase
  from (select item, w, unnest(generate_series(1, greatest(1, len(w) - 9))) as i from items where len(w) > 0)),
texts as (
  select row_number() over () as n, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
places as (
  select n, doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) as i
  from texts, (select distinct size from windows) where len(w) >= size),
found as (
  select n, i, p.size, item
  from (select n, i, size, array_to_string(w[i:i + size - 1], ' ') as phrase from places) p
  join windows using (size, phrase)),
words as (
  select n, count(distinct k) as n_hit
  from (select n, unnest(generate_series(i, i + size - 1)) as k from (select distinct n, i, size from found))
  group by n),
named as (
  select n, count(*) as n_items, string_agg(item, ',' order by item) as listed
  from (select distinct n, item from found where item is not null) group by n)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(listed, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from texts left join words using (n) left join named using (n)
"""

_RULES = r"""
with texts as (
  select row_number() over () as n, doc_id, lang, source, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
counted as (
  select n, doc_id, lang, source, w, len(w)::bigint as n_words,
    length(array_to_string(w, ''))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from texts),
grams as (
  select n, i, array_to_string(w[i:i + 4], ' ') as gram
  from (select n, w, unnest(generate_series(1, len(w) - 4)) as i from texts where len(w) >= 5)),
again as (select n, i from (select n, i, count(*) over (partition by n, gram) as k from grams) where k > 1),
repeated as (
  select n, count(distinct p)::bigint as n_repeat_words
  from (select n, unnest(generate_series(i, i + 4)) as p from again) group by n),
base as (
  select n, doc_id, lang, source, n_words, word_chars, n_symbols, len(lines) as n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words
  from counted left join repeated using (n)),
measured as (
  select *,
    case when n_words > 0 then n_symbols / n_words::double else 0 end as symbol_share,
    case when n_lines > 0 then n_dup_lines / n_lines::double else 0 end as duplicate_line_share,
    case when n_words > 0 then n_repeat_words / n_words::double else 0 end as repeat_share,
    case when n_words > 0 then word_chars / n_words::double else 0 end as word_length
  from base),
metrics as (
  select lang, source, 'symbol_share' as metric, symbol_share as v from measured
  union all select lang, source, 'duplicate_line_share', duplicate_line_share from measured
  union all select lang, source, 'repeat_share', repeat_share from measured
  union all select lang, source, 'word_length', word_length from measured),
sketch as (
  select lang, source, metric,
    case when v > 0 then ceil(ln(v) / ln(1.01 / 0.99))::int end as b, count(*) as k
  from metrics group by all),
levels as (
  select 'own' as level, lang, source, metric, b, k from sketch
  union all select 'lang', lang, null, metric, b, sum(k) from sketch group by lang, metric, b
  union all select 'all', null, null, metric, b, sum(k) from sketch group by metric, b),
summed as (
  select *, sum(k) over (whole order by b nulls first) as upto, sum(k) over whole as total,
    coalesce(power(1.01 / 0.99, b) * 2 / (1.01 / 0.99 + 1), 0) as value_at
  from levels window whole as (partition by level, lang, source, metric)),
ends as (
  select level, lang, source, metric, max(total) as total,
    min_by(value_at, upto) filter (upto > 0.5 * (total - 1)) as median,
    min_by(value_at, upto) filter (upto > 0.9 * (total - 1)) as u1,
    min_by(value_at, upto) filter (upto > 0.95 * (total - 1)) as u2,
    min_by(value_at, upto) filter (upto > 0.99 * (total - 1)) as u3,
    min_by(value_at, upto) filter (upto > 0.999 * (total - 1)) as u4,
    min_by(value_at, upto) filter (upto > 0.1 * (total - 1)) as l1,
    min_by(value_at, upto) filter (upto > 0.05 * (total - 1)) as l2,
    min_by(value_at, upto) filter (upto > 0.01 * (total - 1)) as l3,
    min_by(value_at, upto) filter (upto > 0.001 * (total - 1)) as l4
  from summed group by level, lang, source, metric),
drawn as (
  select o.lang, o.source, o.metric,
    (o.median * o.total + ((l.median * l.total + a.median * 200) / (l.total + 200)) * 200) / (o.total + 200) as median,
    (o.u1 * o.total + ((l.u1 * l.total + a.u1 * 200) / (l.total + 200)) * 200) / (o.total + 200) as u1,
    (o.u2 * o.total + ((l.u2 * l.total + a.u2 * 200) / (l.total + 200)) * 200) / (o.total + 200) as u2,
    (o.u3 * o.total + ((l.u3 * l.total + a.u3 * 200) / (l.total + 200)) * 200) / (o.total + 200) as u3,
    (o.u4 * o.total + ((l.u4 * l.total + a.u4 * 200) / (l.total + 200)) * 200) / (o.total + 200) as u4,
    (o.l1 * o.total + ((l.l1 * l.total + a.l1 * 200) / (l.total + 200)) * 200) / (o.total + 200) as l1,
    (o.l2 * o.total + ((l.l2 * l.total + a.l2 * 200) / (l.total + 200)) * 200) / (o.total + 200) as l2,
    (o.l3 * o.total + ((l.l3 * l.total + a.l3 * 200) / (l.total + 200)) * 200) / (o.total + 200) as l3,
    (o.l4 * o.total + ((l.l4 * l.total + a.l4 * 200) / (l.total + 200)) * 200) / (o.total + 200) as l4
  from ends o
  join ends l on l.level = 'lang' and l.metric = o.metric and l.lang is not distinct from o.lang
  join ends a on a.level = 'all' and a.metric = o.metric
  where o.level = 'own'),
fences as (
  select lang, source, metric, case when metric = 'word_length' then lower - 3 * (median - lower) end as low,
    upper + 3 * (upper - median) as high
  from (select *,
      case when u1 > median then u1 when u2 > median then u2 when u3 > median then u3 when u4 > median then u4 end as upper,
      case when l1 < median then l1 when l2 < median then l2 when l3 < median then l3 when l4 < median then l4 end as lower
    from drawn)),
broken as (
  select m.n, count(*) as k
  from measured m join fences f
    on f.lang is not distinct from m.lang and f.source is not distinct from m.source
  where (case f.metric when 'symbol_share' then symbol_share when 'repeat_share' then repeat_share
      when 'duplicate_line_share' then duplicate_line_share else word_length end) > f.high
    or (f.metric = 'word_length' and word_length < f.low)
  group by m.n)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and k is null as kept
from (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from measured)
left join broken using (n)
"""

_NEAR = r"""
with recursive texts as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i:i + 1], ' ') as gram
  from (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 1))) as i
    from texts where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as k
  from shingles a join shingles b on a.gram = b.gram and a.doc_id < b.doc_id
  group by all),
links as (
  select x, y from shared join sizes a on a.doc_id = x join sizes b on b.doc_id = y
  where 100 * k >= 80 * (a.n + b.n - k)),
steps as (select x, y from links union all select y, x from links),
reach as (
  select x, y from steps
  union
  select r.x, s.y from reach r join steps s on r.y = s.x),
tops as (select x as doc_id, min(y) as top from reach group by x)
select doc_id, coalesce(n, 0)::bigint as n_shingles, least(doc_id, coalesce(top, doc_id)) as component_id,
  doc_id = least(doc_id, coalesce(top, doc_id)) as kept
from texts left join sizes using (doc_id) left join tops using (doc_id)
"""

_AUDIT = r"""
with texts as (
  select d.doc_id, coalesce(d.lang, '') as part, coalesce(d.text, '') as t,
    regexp_extract_all(coalesce(d.text, ''), '[^\x20\x09-\x0D]+') as w,
    exists (select 1 from labels l where l.doc_id = d.doc_id and l.quality = 1) as good,
    exists (select 1 from labels l where l.doc_id = d.doc_id and l.toxic = 1) as toxic
  from documents d),
failed as (
  select part, good, toxic, [
    len(w) < 200,
    100 * len(list_distinct(w)) < 50 * len(w),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
    regexp_matches(t, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) over (partition by t), false)] as fails
  from texts),
cells as (
  select part, fails, count(*) as n, count(*) filter (good) as n_good, count(*) filter (toxic) as n_toxic
  from failed group by part, fails),
letters as (select unnest([1, 2, 3, 4, 5]) as x),
orders as (
  select [a.x, b.x, c.x, d.x, e.x] as o,
    array_to_string(list_transform([a.x, b.x, c.x, d.x, e.x], lambda i: 'ABCDE'[i]), '') as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as (
  select part, filter_order, s.x as step, o[s.x] as letter, n, n_good, n_toxic,
    fails[o[s.x]] as fails,
    len(list_filter(o[1:s.x - 1], lambda i: fails[i])) > 0 as gone,
    len(list_filter(fails, lambda f: f)) as n_failed
  from cells, orders, letters s),
summed as (
  select part, filter_order, step, letter,
    coalesce(sum(n) filter (not fails and not gone), 0)::bigint as kept,
    coalesce(sum(n) filter (fails and not gone), 0)::bigint as removed,
    coalesce(sum(n) filter (fails and gone), 0)::bigint as redundant,
    coalesce(sum(n) filter (fails and n_failed = 1), 0)::bigint as unique_fails,
    coalesce(sum(n_good) filter (fails and not gone), 0)::bigint as good_lost,
    coalesce(sum(n_toxic) filter (fails and not gone), 0)::bigint as toxic_lost
  from steps group by part, filter_order, step, letter)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, letter))::bigint as shapley
from summed
"""

SQL: dict[str, str] = {
    "op13_filter_audit": _AUDIT,
    "op5_near_duplicates": _NEAR,
    "op10_quality_rules": _RULES,
    "op7_chat_formatting": _CHAT,
    "op9_decontamination": _HITS,
}
