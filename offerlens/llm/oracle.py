"""The same results in SQL for a second engine, where SQL can express them.

Given for the quality rules, the Jaccard join and the decontamination. Block selection and
packing, trained fields, the pattern graph, the tokenizer and the mixed model have no SQL;
their tests compare with brute force, by enumeration, or on held-out cases.
"""

from offerlens.llm.quality import MAX_REPEAT_PERCENT, MIN_WORDS, PASSAGE, RULES, STOP_WORDS, Rule

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_NUMBERED = "select row_number() over () as row_no, doc_id, coalesce(text, '') as text from documents"


def _lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_UPPER.lower()}')"


def _passes(rule: Rule) -> str:
    ratio = f"(case when {rule.whole} > 0 then {rule.part} / {rule.whole} else 0 end)"
    bounds = [f"{ratio} >= {rule.at_least}"] if rule.at_least is not None else []
    bounds += [f"{ratio} <= {rule.at_most}"] if rule.at_most is not None else []
    exempt = f"n_words < {rule.from_words} or " if rule.from_words else ""
    return f"({exempt}({' and '.join(bounds)}))"


_STOP_LIST = ", ".join(f"'{word}'" for word in STOP_WORDS)

QUALITY = f"""
with docs as ({_NUMBERED}),
split as (
  select row_no, doc_id, text, regexp_extract_all(text, '{_WORD}') as words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as lines
  from docs),
grams as (
  select row_no, i, list_slice(words, i, i + {PASSAGE - 1}) as gram
  from split, unnest(range(1, len(words) - {PASSAGE - 2})) as t(i)),
repeats as (
  select row_no, unnest(range(i, i + {PASSAGE})) as place
  from (select row_no, i, count(*) over (partition by row_no, gram) as n from grams) where n > 1),
covered as (select row_no, count(distinct place) as n from repeats group by row_no),
counted as (
  select doc_id, cast(len(words) as bigint) as n_words,
         cast(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
         cast(coalesce(n, 0) as bigint) as n_repeat_words,
         cast(len(lines) as bigint) as n_lines,
         cast(len(list_filter(words, lambda x: lower(x) in ({_STOP_LIST}))) as bigint) as n_stop_words
  from split left join covered using (row_no)),
judged as (
  select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words as base_failed from counted)
select *, not base_failed and {' and '.join(map(_passes, RULES))} as kept from judged
"""

JACCARD = f"""
with recursive docs as ({_NUMBERED}),
split as (select row_no, doc_id, regexp_extract_all({_lower('text')}, '{_WORD}') as words from docs),
shingles as (
  select distinct row_no, array_to_string(list_slice(words, i, i + 4), ' ') as gram
  from split, unnest(range(1, greatest(len(words) - 3, 2))) as t(i) where len(words) > 0),
sizes as (select row_no, count(*) as n from shingles group by row_no),
common as (
  select a.row_no as a, b.row_no as b, count(*) as n
  from shingles a join shingles b on a.gram = b.gram and a.row_no < b.row_no group by 1, 2),
links as (
  select a, b from common join sizes x on a = x.row_no join sizes y on b = y.row_no
  where 100 * common.n >= 80 * (x.n + y.n - common.n)),
both_ways as (select a, b from links union all select b, a from links),
reach(a, b) as (
  select row_no, row_no from docs
  union
  select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a),
components as (select reach.a as row_no, min(doc_id) as component_id from reach join docs on reach.b = docs.row_no group by 1)
select doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, component_id
from docs join components using (row_no) left join sizes using (row_no)
"""

_WORD10 = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
with docs as ({_NUMBERED}),
words as (select row_no, doc_id, regexp_extract_all({_lower('text')}, '{_WORD10}') as words from docs),
items as (
  select cast(item_id as varchar) as item_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_WORD10}') as words
  from benchmark),
windows as (
  select distinct item_id, list_slice(words, i, i + 12) as gram
  from items, unnest(range(1, greatest(len(words) - 11, 2))) as t(i) where len(words) > 0),
lengths as (select distinct len(gram) as n from windows),
places as (
  select row_no, i, n, list_slice(words, i, i + n - 1) as gram
  from words, lengths, unnest(range(1, len(words) - n + 2)) as t(i)),
hits as (select row_no, i, n, item_id from places join windows using (gram)),
hit_words as (
  select row_no, count(distinct place) as n_hit
  from (select distinct row_no, unnest(range(i, i + n)) as place from hits) group by row_no),
hit_items as (
  select row_no, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as ids
  from hits group by row_no)
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from words left join hit_words using (row_no) left join hit_items using (row_no)
"""

LLM_ORACLES: dict[str, str] = {
    "op2_quality_rules": QUALITY,
    "op5_jaccard_join": JACCARD,
    "op10_decontaminate": DECONTAMINATION,
}
