"""SQL for the operators that SQL can express."""

from __future__ import annotations

from acctcube.llm.quality_rules import STOP_WORDS

ORACLE: dict[str, str] = {}

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

ORACLE["op3_quality_rules"] = rf"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t from documents
), w as (
  select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from d
), g as (
  select r, i, w[i] as a, w[i + 1] as b, w[i + 2] as c
  from (select r, w, unnest(generate_series(1, len(w) - 2)) as i from w)
), dup as (
  select r, i from (select r, i, count(*) over (partition by r, a, b, c) as n from g) where n > 1
), covered as (
  select r, count(distinct i + k) as n from dup, (values (0), (1), (2)) as o(k) group by r
), m as (
  select doc_id, cast(len(w) as bigint) as n_words,
    cast(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines,
    cast(coalesce(covered.n, 0) as bigint) as n_repeat_words,
    len(list_filter(w, lambda x: lower(x) in ({_STOP}))) as stop,
    len(list_filter(w, lambda x: upper(x) = x and lower(x) <> x and length(x) > 1)) as capital,
    len(l) as n_lines,
    cast(coalesce(list_max(list_transform(w, lambda x: length(x))), 0) as integer) as longest_word_chars
  from w left join covered using (r)
), q as (
  select *,
    case when n_words > 0 then word_chars / n_words else 0.0 end as mean_word_chars,
    case when n_words > 0 then n_symbols / n_words else 0.0 end as symbols_per_word,
    case when n_words > 0 then stop / n_words else 0.0 end as stop_word_share,
    case when n_words > 0 then capital / n_words else 0.0 end as capital_word_share,
    case when n_lines > 0 then n_dup_lines / n_lines else 0.0 end as dup_line_share,
    n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed
  from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, mean_word_chars,
  symbols_per_word, stop_word_share, capital_word_share, dup_line_share, longest_word_chars, base_failed,
  not base_failed and mean_word_chars between 2.0 and 14.0 and symbols_per_word <= 0.10
    and stop_word_share >= 0.04 and capital_word_share <= 0.20 and dup_line_share <= 0.50
    and longest_word_chars <= 1000 as kept
from q
"""

ORACLE["op13_hard_negatives"] = """
with e as (
  select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select a.r as a, a.vec_id as anchor_id, b.vec_id, a.label = b.label as same,
    cast(list_inner_product(a.v, b.v) as bigint) as score
  from e as a, e as b
  where a.vec_id % 50 = 0 and a.r <> b.r and len(a.v) = len(b.v)
), p as (
  select *, row_number() over (partition by a order by score desc, vec_id) as k from s where same
), n as (
  select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
    row_number() over (partition by p.a, p.k order by s.score desc, s.vec_id) as rank
  from p join s using (a)
  where p.k <= 5 and not s.same and 50 * p.score <= 100 * s.score and 100 * s.score <= 95 * p.score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 3
"""
