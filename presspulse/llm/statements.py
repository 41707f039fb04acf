"""SQL statements of the queries that SQL can express, written independently of the operators."""

from __future__ import annotations

from presspulse.llm.quality_rules import BOILERPLATE, SEPARATORS

_ENDS = "''".join(".!?…:;\"'”’»)]。！？".split("'"))

LINE_QUALITY = rf"""
with texts as (select doc_id, row_number() over () as r, coalesce(text, '') as text from documents),
lines as (
  select r, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos from texts),
worded as (
  select *, row_number() over (partition by r, line order by pos) > 1 as again,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as n,
    length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) as chars,
    length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) as symbols,
    length(regexp_replace(line, '[^!]', '', 'g')) as shouts,
    length(regexp_replace(line, '[^.!?:;]', '', 'g')) as inner_ends,
    right(regexp_replace(line, '[\x20\x09-\x0D]+$', ''), 1) as last,
    len(list_filter(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), lambda w: w in ({", ".join(f"'{s}'" for s in SEPARATORS)}))) as separators
  from lines where regexp_matches(line, '[^\x20\x09-\x0D]')),
judged as (
  select *, again or 2 * symbols > n or 2 * shouts > n or (n >= 12 and inner_ends = 0 and position(last in '{_ENDS}') = 0)
    or (separators >= 3 and 4 * separators >= n)
    or (n <= 30 and ({" or ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)})) as failed
  from worded),
line_sums as (
  select r, sum(n)::bigint as n_words, sum(chars)::bigint as word_chars,
    sum(again::int)::bigint as n_dup_lines, count(*) as n_lines, sum(failed::int)::bigint as n_removed_lines,
    coalesce(sum(chars) filter (not failed), 0)::bigint as left_chars
  from judged group by r),
words as (
  select r, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as w,
    generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) as i from texts),
windows as (
  select r, i, w, lead(w, 1) over o as w1, lead(w, 2) over o as w2 from words window o as (partition by r order by i)),
twice as (
  select r, i, w2 is not null and count(*) over (partition by r, w, w1, w2) > 1 as hit from windows),
covered as (
  select r, i, hit or coalesce(lag(hit, 1) over o, false) or coalesce(lag(hit, 2) over o, false) as c
  from twice window o as (partition by r order by i)),
repeats as (select r, sum(c::int)::bigint as n_repeat_words from covered group by r),
sums as (
  select doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
    coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines,
    coalesce(n_removed_lines, 0) as n_removed_lines, coalesce(left_chars, 0) as left_chars
  from texts left join line_sums using (r) left join repeats using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and left_chars >= 0.5 * word_chars as kept,
  n_lines, n_removed_lines, left_chars
from sums
"""
