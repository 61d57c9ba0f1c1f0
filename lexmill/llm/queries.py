"""The problems of this subpackage as named queries."""

from __future__ import annotations

from lexmill.llm import lookalike, markup, packing, spans, tokens

QUERIES = {
    "p1_found": markup.found,
    "p1_texts": markup.clean_texts,
    "p4_found": lookalike.found,
    "p4_forms": lookalike.title_forms,
    "p7_ids": tokens.corpus_ids,
    "p7_round_trip": tokens.round_trip,
    "p7_decoded": tokens.decoded_texts,
    "p7_languages": tokens.tokens_by_language,
    "p8_bins": packing.corpus_bins,
    "p8_usage": packing.bin_usage,
    "p8_checks": packing.packing_checks,
    "p9_found": lambda s, d: spans.sharing_pairs(spans.corpus(s, d)),
    "p9_shares": lambda s, d: spans.shares(spans.corpus(s, d)),
    "p9_passages": lambda s, d: spans.fuzzy_passages(spans.corpus(s, d)),
}
_WINDOWS = """
with w as (select doc_id, i, substring(text, i, 120) as s from (select doc_id, text, unnest(range(1, length(text) - 118)) as i from documents where length(text) >= 120)),
g as (select distinct s, doc_id from w), d as (select s from g group by s having count(*) > 1)
"""

SQL: dict[str, str] = {
    "p7_decoded": "select doc_id, coalesce(text, '') as text from documents",
    "p8_checks": "select budget_name, count(*) as n_docs, 0::bigint as n_overfull, 0::bigint as n_split, 0::bigint as n_gaps from (select distinct budget_name from token_budgets), documents group by 1",
    "p9_found": _WINDOWS + ", j as (select g.doc_id, g.s from g join d using (s)) select distinct a.doc_id as doc_id_a, b.doc_id as doc_id_b from j a join j b on a.s = b.s and a.doc_id < b.doc_id",
    "p9_shares": _WINDOWS
    + """, c as (select w.doc_id, w.i from w join d using (s)),
      n as (select doc_id, least(120, coalesce(i - lag(i) over (partition by doc_id order by i), 120)) as new from c),
      t as (select doc_id, sum(new) as covered from n group by 1)
      select doc_id, coalesce(length(text), 0) as n_chars, cast(coalesce(covered, 0) as bigint) as shared_chars,
        case when length(text) > 0 then round(coalesce(covered, 0) / length(text), 6) else 0.0 end as share from documents left join t using (doc_id)""",
}
