"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from atende.llm import decontamination as d
from atende.llm import quality_rules as q


def _text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _list(xs) -> str:
    return "[" + ", ".join(map(_text, xs)) + "]"


_CLOSING = "' \"''”’»)]' || chr(9) || chr(11) || chr(12) || chr(13)"
_MENU_MARKS = "".join(q.MENU_MARK)

OP1 = f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select r, list_filter(regexp_split_to_array(t, '{q.SPACE}+'), lambda x: x <> '') as ws from d),
win as (
  select r, i, count(*) over (partition by r, array_to_string(ws[i:i + {q.WINDOW_WORDS - 1}], ' ')) as n
  from (select r, ws, unnest(range(1, len(ws) - {q.WINDOW_WORDS - 2})) as i from w)
),
rep as (
  select r, sum(least({q.WINDOW_WORDS}, coalesce(nxt - i, {q.WINDOW_WORDS}))) as n_repeat
  from (select r, i, lead(i) over (partition by r order by i) as nxt from win where n > 1) group by r
),
ln as (select r, n_line, l from (
  select r, unnest(string_split(t, chr(10))) as l, unnest(range(1, len(string_split(t, chr(10))) + 1)) as n_line from d)),
lr as (
  select r, n_line, l, regexp_matches(l, '{q.WORD}') as has_word,
    length(l) - length(translate(l, {_text(_MENU_MARKS)}, '')) >= {q.MENU_MARKS} or regexp_matches(l, {_text(q.MENU_LINE)}) as menu,
    list_any_value(list_filter({_list(q.BOILERPLATE)}, lambda p: contains(lower(l), p))) is not null as boiler,
    length(l) - length(regexp_replace(l, '{q.SYMBOLS}', '', 'g')) as syms,
    len(list_filter(regexp_split_to_array(l, '{q.SPACE}+'), lambda x: x <> '')) as n_w,
    (length(l) - length(replace(l, '{q.SHOUT}', ''))) >= {len(q.SHOUT) * q.SHOUTS} as shout,
    list_contains({_list(q.SENTENCE_END)}, right(rtrim(l, {_CLOSING}), 1)) as ended
  from ln
),
lp as (
  select *, not has_word or (ended and not menu and not boiler and not shout and not (syms > 0 and {q.WORDS_PER_SYMBOL} * syms >= n_w)) as passed
  from lr
),
doc as (
  select r, count(*) filter (has_word) - count(distinct l) filter (has_word) as n_dup_lines,
    coalesce(string_agg(l, chr(10) order by n_line) filter (passed), '') as clean
  from lp group by r
),
fig as (
  select d.doc_id, len(ws) as n_words, length(array_to_string(ws, '')) as word_chars,
    length(t) - length(regexp_replace(t, '{q.SYMBOLS}', '', 'g')) as n_symbols, n_dup_lines,
    cast(coalesce(n_repeat, 0) as bigint) as n_repeat_words, length(t) as chars_in, length(clean) as chars_out
  from d join w using (r) join doc using (r) left join rep using (r)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < {q.MIN_WORDS} or 100 * n_repeat_words > {q.MAX_REPEAT_PCT} * n_words as base_failed,
  not (n_words < {q.MIN_WORDS} or 100 * n_repeat_words > {q.MAX_REPEAT_PCT} * n_words)
    and not (100 * (chars_in - chars_out) > {q.MAX_LOSS_PCT} * chars_in) as kept
from fig
"""

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{d.UPPER}', '{d.LOWER}'), '{d.WORD}') as ws"

OP11 = f"""
with w as (select row_number() over () as r, doc_id, {_WORDS} from documents),
b as (select item_id, {_WORDS} from benchmark),
g as (
  select distinct item_id, k, array_to_string(ws[i:i + k - 1], ' ') as gram
  from (select item_id, ws, least(len(ws), {d.WINDOW}) as k, unnest(range(1, greatest(len(ws) - {d.WINDOW - 1}, 1) + 1)) as i from b where len(ws) > 0)
),
sizes as (select distinct k from g),
dw as (
  select r, i, k, array_to_string(ws[i:i + k - 1], ' ') as gram
  from (select r, ws, k, unnest(range(1, len(ws) - k + 2)) as i from w join sizes on len(ws) >= k)
),
h as (select r, i, k, item_id from dw join g using (gram, k)),
hit as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + k)) as p from h) group by r),
items as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as names
  from (select distinct r, cast(item_id as varchar) as item from h where item_id is not null) group by r
)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join hit using (r) left join items using (r)
"""

ANSWERS: dict[str, str] = {"op1_quality_rules": OP1, "op11_decontamination": OP11}
