"""DuckDB SQL for the operators that SQL can state."""

from __future__ import annotations

from catalog_lake.llm import line_dedup, quality

BLANK = r"[\x20\x09-\x0D]"


def quality_ctes(source: str, rules: tuple[quality.Rule, ...] = quality.RULES) -> str:
    """CTEs up to ``judged`` (rid, counts, base_failed, kept) over ``source`` (rid, text)."""
    stop = ", ".join(f"'{w}'" for w in quality.STOP_WORDS)
    verdict = " and ".join(
        f"{r.metric} {op} {v}" for r in rules for op, v in ((">=", r.low), ("<=", r.high)) if v is not None)
    return rf"""
q_in as (select rid, coalesce(text, '') as t from {source}),
q_words as (
  select rid, i, w from (
    select rid, unnest(ws) as w, generate_subscripts(ws, 1) as i from (
      select rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws from q_in))),
q_grams as (
  select rid, i, w, lead(w) over d as w2, lead(w, 2) over d as w3 from q_words window d as (partition by rid order by i)),
q_rep as (
  select rid, i from (select rid, i, count(*) over (partition by rid, w, w2, w3) as n from q_grams where w3 is not null)
  where n > 1),
q_cov as (select rid, count(distinct i + o) as n_repeat_words from q_rep, (select unnest([0, 1, 2]) as o) group by rid),
q_w as (
  select rid, count(*) as n_words, sum(length(w)) as word_chars, count(*) filter (lower(w) in ({stop})) as n_stop
  from q_words group by rid),
q_lines as (
  select rid, count(*) as n_lines, count(*) - count(distinct x) as n_dup_lines,
         count(*) filter (regexp_matches(x, '^[\x20\x09-\x0D]*([-*+]|\x{{2022}}|\x{{2023}}|\x{{25CF}})[\x20\x09]')) as n_bullet,
         count(*) filter (regexp_matches(x, '([.][.][.]|\x{{2026}})[\x20\x09-\x0D]*$')) as n_ell
  from (select rid, unnest(string_split(t, chr(10))) as x from q_in) where regexp_matches(x, '[^\x20\x09-\x0D]') group by rid),
q_all as (
  select rid, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
         coalesce(n_stop, 0) as n_stop, coalesce(n_lines, 0) as n_lines, coalesce(n_bullet, 0) as n_bullet,
         coalesce(n_ell, 0) as n_ell
  from q_in left join q_w using (rid) left join q_lines using (rid) left join q_cov using (rid)),
q_ratios as (
  select *, word_chars / greatest(n_words, 1) as mean_word_chars, n_symbols / greatest(n_words, 1) as symbol_ratio,
         n_stop / greatest(n_words, 1) as stop_word_ratio, n_dup_lines / greatest(n_lines, 1) as dup_line_ratio,
         n_bullet / greatest(n_lines, 1) as bullet_line_ratio, n_ell / greatest(n_lines, 1) as ellipsis_line_ratio,
         n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed
  from q_all),
judged as (select *, not base_failed and {verdict} as kept from q_ratios)"""


def lines_ctes(source: str, min_sites: int = line_dedup.MIN_SITES) -> str:
    """CTEs up to ``cleaned`` (rid, n_lines, n_removed, clean) over ``source`` (rid, doc_id, text, source)."""
    return rf"""
l_all as (
  select rid, doc_id, source, unnest(ls) as x, generate_subscripts(ls, 1) as i
  from (select rid, doc_id, source, string_split(text, chr(10)) as ls from {source})),
l_keyed as (select *, regexp_replace(x, '^{BLANK}+|{BLANK}+$', '', 'g') as k from l_all),
l_wide as (
  select k, min(doc_id) as first_doc from l_keyed where k <> '' group by k having count(distinct source) >= {min_sites}),
l_marked as (
  select a.*, b.k is not null and (a.doc_id is null or first_doc is null or a.doc_id > first_doc) as gone
  from l_keyed a left join l_wide b on a.k = b.k),
l_doc as (
  select rid, count(*) as n_lines, count(*) filter (gone) as n_removed,
         coalesce(string_agg(x, chr(10) order by i) filter (not gone), '') as clean
  from l_marked group by rid),
cleaned as (
  select s.*, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, clean
  from {source} s left join l_doc using (rid))"""


def hits_ctes(source: str, window: int = 13) -> str:
    """CTEs up to ``contaminated`` (rid, n_words, n_hit, n_items, items) over ``source`` (rid, text) and benchmark."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return rf"""
c_items as (select item_id, {words} as ws from benchmark),
c_win as (
  select distinct item_id, k, array_to_string(ws[s:s + k - 1], ' ') as win
  from (select *, unnest(generate_series(1, len(ws) - k + 1)) as s
        from (select *, least({window}, len(ws)) as k from c_items where len(ws) > 0))),
c_docs as (select rid, {words} as ws from {source}),
c_occ as (
  select rid, s, k, array_to_string(ws[s:s + k - 1], ' ') as win
  from (select rid, ws, k, unnest(generate_series(1, len(ws) - k + 1)) as s
        from c_docs, (select distinct k from c_win) where len(ws) >= k)),
c_found as (select rid, s, k, item_id from c_occ join c_win using (k, win)),
c_hit as (
  select rid, count(distinct p) as n_hit from (select distinct rid, unnest(generate_series(s, s + k - 1)) as p from c_found)
  group by rid),
c_ids as (
  select rid, count(*) as n_items, string_agg(i, ',' order by i) as items
  from (select distinct rid, cast(item_id as varchar) as i from c_found) group by rid),
contaminated as (
  select rid, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, coalesce(items, '') as items
  from c_docs left join c_hit using (rid) left join c_ids using (rid))"""


DOCS = "docs as (select row_number() over () as rid, * from documents)"

ORACLES = {
    "op1_line_dedup": f"with {DOCS}, {lines_ctes('docs')} select doc_id, n_lines, n_removed, clean as text from cleaned",
    "op3_quality_rules": f"""with {DOCS}, {quality_ctes('docs')}
select doc_id, n_words, cast(word_chars as bigint) as word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
from judged join docs using (rid)""",
    "op10_benchmark_decontamination": f"""with {DOCS}, {hits_ctes('docs')}
select doc_id, n_words, n_hit, n_items, sha256(items) as items_sha256, n_hit > 0 and 20 * n_hit >= n_words as contaminated
from contaminated join docs using (rid)""",
}
