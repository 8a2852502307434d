"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from basketry.llm import quality_rules as rules
from basketry.llm import suffix_dedup


def _listed(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def quality() -> str:
    """Base figures and line rules."""
    ends = _listed([*rules.TERMINAL, *rules.CLOSERS])
    separators = _listed(s.decode() for s in rules.SEPARATORS)
    phrases = "|".join(rules.BOILERPLATE)
    return rf"""
with docs as (
  select doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
lines as (
  select doc_id, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') as words
  from (select doc_id, unnest(string_split(text, chr(10))) as line from docs)),
judged as (
  select doc_id, line, list_sum(list_transform(words, lambda w: length(w))) as size,
    (right(regexp_replace(line, '\s+$', ''), 1) not in ({ends})
      and {rules.SENTENCE_WORDS} * len(list_filter(words, lambda w: right(w, 1) in ('.', '!', '?'))) < len(words))
    or list_sum(list_transform(words, lambda w: length(w) - length(regexp_replace(w, '[#*$%&|<>]', '', 'g'))))
      > {rules.MAX_SYMBOLS_PER_WORD} * len(words)
    or len(list_filter(words, lambda w: w in ({separators}))) > {rules.MAX_SEPARATORS}e0 * len(words)
    or (len(words) >= {rules.MIN_SHOUTED_WORDS}
      and len(list_filter(words, lambda w: regexp_matches(w, '[A-Z]') and not regexp_matches(w, '[a-z]')))
        > {rules.MAX_UPPER}e0 * len(words))
    or regexp_matches(line, '(?i){phrases}') as failed
  from lines where len(words) > 0),
per_line as (
  select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines,
    count(*) filter (failed) as n_failed_lines, cast(coalesce(sum(size) filter (failed), 0) as bigint) as lost_chars
  from judged group by doc_id),
windows as (
  select doc_id, i, words[i:i + 2] as w from (select doc_id, words, unnest(range(1, len(words) - 1)) as i from docs)),
inside as (
  select doc_id, count(distinct i + k) as n_repeat_words
  from (select doc_id, i, count(*) over (partition by doc_id, w) as times from windows), range(0, 3) r(k)
  where times > 1 group by doc_id),
figures as (
  select doc_id, len(words) as n_words,
    cast(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) as bigint) as word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
    coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
    coalesce(n_lines, 0) as n_lines, coalesce(n_failed_lines, 0) as n_failed_lines,
    coalesce(lost_chars, 0) as lost_chars
  from docs left join per_line using (doc_id) left join inside using (doc_id)),
based as (
  select *, n_words < {rules.MIN_WORDS} or 100 * n_repeat_words > {rules.MAX_REPEAT_PERCENT} * n_words as base_failed
  from figures)
select *, not base_failed and lost_chars <= {rules.MAX_LOST}e0 * word_chars as kept from based"""


def repeats() -> str:
    """Every string by itself, as hexadecimal digits."""
    n = suffix_dedup.LENGTH
    return f"""
with docs as (select doc_id, hex(encode(coalesce(text, ''))) as digits from documents),
strings as (
  select doc_id, i, md5(substr(digits, 2 * i + 1, {2 * n})) as string
  from (select doc_id, digits, unnest(range(0, cast(length(digits) / 2 as bigint) - {n - 1})) as i from docs)),
found as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by string) as times from strings) where times > 1),
steps as (select doc_id, i, lag(i) over (partition by doc_id order by i) as before from found),
numbered as (
  select doc_id, i, sum(case when before is null or i > before + {n} then 1 else 0 end)
    over (partition by doc_id order by i) as run from steps),
runs as (select doc_id, run, min(i) as lo, max(i) + {n} as hi from numbered group by doc_id, run),
cuts as (
  select doc_id, lo, hi, coalesce(lag(hi) over (partition by doc_id order by lo), 0) as since from runs),
kept as (
  select doc_id, sum(hi - lo) as n_removed, count(*) as n_spans, max(hi) as last,
    string_agg(substr(digits, 2 * since + 1, 2 * (lo - since)), '' order by lo) as front
  from cuts join docs using (doc_id) group by doc_id)
select doc_id, cast(length(digits) / 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(front, '') || substr(digits, 2 * coalesce(last, 0) + 1))) as kept_sha256
from docs left join kept using (doc_id)"""
