"""Queries over hard rows against brute force on a fixture."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from urllib.parse import quote, quote_plus

import pytest

from lexmill.plans import core, scalars  # noqa: F401
from lexmill.wikitext import expand


def test_lookup_in_every_script(spark, tmp_path):
    titles = ["Éclair", "éclair", "Слово", "ΣΟΦΟΣ", "STRASSE", "Straße", "İstanbul", "Cafe", "café", "CAFÉ", "caña", None]
    wanted = ["éCLAIR", "éclair", "СЛОВО", "σοφος", "straße", "istanbul", "cAfE", "нет", None]
    spark.createDataFrame([(i, 0, t) for i, t in enumerate(titles)], "id long, ns int, title string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(t,) for t in wanted], "title string").write.parquet(f"{tmp_path}/bundle_pages.parquet")
    expected = {}
    for q in wanted[:-1]:
        hits = [t for t in titles if t is not None and t.lower() == q.lower()]
        best = min(hits, key=lambda t: (t != q, t.encode())) if hits else None
        expected[q] = (best, best == q if hits else None)
    assert {r["query"]: (r.title, r.exact) for r in core.QUERIES["lookup_folded"](spark, str(tmp_path)).collect()} == expected


def test_search_in_every_script(spark, tmp_path):
    titles = [f"Ca{c}" for c in "éñабвгÀz"] + ["cab", "CAÉ"]
    spark.createDataFrame([(i, 0, t) for i, t in enumerate(titles)], "id long, ns int, title string").write.parquet(f"{tmp_path}/pages.parquet")
    expected = sorted(((t.lower().encode(), t.encode(), i, t) for i, t in enumerate(titles)))[5:25]
    got = core.QUERIES["search_page"](spark, str(tmp_path)).collect()
    assert [(r.id, r.title) for r in got] == [(i, t) for _, _, i, t in expected]
    assert {(r.total, r.has_more) for r in got} == {(len(titles), False)}


HARD = ["Éclair au thé", "ﬁn", "日本/語 x", 'a & b <i> "q"', "it's 100% #1?", "Слово слово", "e\u0301a", "#", "абв:где", "12 ab", "ßtraße", "x\u00a0y", "plain title", "a*b~c", "𐍈 gothic", "Template:Ünder_x"]


def _hard(spark, tmp_path):
    spark.createDataFrame([(i, 0, t) for i, t in enumerate([*HARD, None])], "id long, ns int, title string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(i, 0, t) for i, t in enumerate([*HARD, None])], "id long, ns int, title string").write.parquet(f"{tmp_path}/redirects.parquet")
    names = [(0, "", "", "case-sensitive"), (10, "Template", "Template", "case-sensitive")]
    spark.createDataFrame(names, "id int, name string, canonical_name string, case_policy string").write.parquet(f"{tmp_path}/namespace_registry.parquet")
    return lambda name: {r["id"]: r.asDict() for r in core.QUERIES[name](spark, str(tmp_path)).collect()}


def test_scalars_on_hard_titles(spark, tmp_path):
    run = _hard(spark, tmp_path)
    more, layout, lua, urls, parts, keys, normal = (run(f"{n}") for n in ("string_more", "string_layout", "lua_patterns", "url_functions", "url_parts", "title_keys", "title_normal"))
    for i, t in enumerate(HARD):
        first = t[0] if t[0] == "ß" else t[0].upper()
        assert more[i] == {"id": i, "title": t, "up_first": first + t[1:], "low_first": t[0].lower() + t[1:], "bytes": t.encode().hex().upper(), "hash": hashlib.md5(t.encode()).hexdigest(), "word": t.split(" ")[0], "n_words": len(t.split(" ")), "trimmed": t.strip("aeiou"), "again": t}
        safe = t.replace("&", "&amp;").replace(">", "&gt;").replace("<", "&lt;").replace('"', "&quot;").replace("'", "&#39;").replace("\u00a0", "&nbsp;")
        pad = max(12 - len(t), 0)
        assert layout[i] == {"id": i, "title": t, "cut": t[:5] + "…" if len(t) > 6 else t, "padded_left": "*" * pad + t, "padded_right": t + ("ab" * 6)[:pad], "encoded": safe, "tagged": f'<b id="{safe}" x>{t}</b>'}
        lead = re.match("[A-Za-z]+", t)
        assert lua[i] == {"id": i, "title": t, "lead": lead and lead[0], "marked": re.sub("[aeiou]", "<>", t), "n_words": len(re.findall("[A-Za-z]+", t)), "swapped": re.sub("([a-z])([a-z])", r"\2\1", t)}
        wiki = quote(t.replace(" ", "_"), safe=";@$!*(),/~:")
        assert urls[i] == {"id": i, "title": t, "q": quote_plus(t, safe=""), "w": wiki, "back": t}
        query = f"a={i}&b=1&a=2"
        assert parts[i] == {"id": i, "protocol": "https", "host": "w.example", "port": 8080, "path": "/wiki/" + wiki, "query": query, "fragment": "top", "whole": f"https://w.example:8080/wiki/{wiki}?{query}#top", "a_values": f"{i},2", "valid": True}
        assert (keys[i]["spaced"], keys[i]["dbkey"]) == (re.sub("[ _\u00a0]+", " ", t).strip(), re.sub("[ _]+", "_", t.split("#")[0]).strip("_"))
        bare = re.sub("[ _\u00a0]+", " ", unicodedata.normalize("NFC", t)).split("#")[0].strip()
        assert (normal[i]["ns_id"], normal[i]["normal"]) == ((10 if t.startswith("Template:") else 0, bare) if bare else (None, None))
    assert set(more) == set(normal) == set(parts) == set(range(len(HARD)))
    assert keys[len(HARD)] == {"id": len(HARD), "ns": 0, "title": None, "spaced": None, "dbkey": None}


def test_every_timestamp_and_source(spark, tmp_path):
    cases = [("2021-01-01T01:30:03+02:00", "20201231233003"), ("2023-05-18 04:25:23", "20230518042523"), ("2020-02-29T23:59:59-05:00", "20200301045959"), ("2022-05-10T07:41:46Z", "20220510074146"), ("soon", None), (None, None)]
    sources = ["<nowiki>{{a}}</nowiki>", "<nowiki>{{a}}</nowiki> {{b}}", "<!-- {{a}} --> x", "<!-- x", "{{c}} <!-- d -->", "plain"]
    rows = [(i, t, x) for i, ((t, _), x) in enumerate(zip(cases, sources, strict=True))]
    spark.createDataFrame(rows, "revision_id long, revision_timestamp string, source string").write.parquet(f"{tmp_path}/bundle_pages.parquet")
    words = {r.revision_id: (r.ts, r.compact, r.year, r.month1) for r in core.QUERIES["revision_words"](spark, str(tmp_path)).collect()}
    assert words == {i: (t, c, c and c[:4], c and str(int(c[4:6]))) for i, (t, c) in enumerate(cases)}
    found = {r.revision_id: (r.unresolved, r.failed) for r in core.QUERIES["markup_diagnostics"](spark, str(tmp_path)).collect()}
    assert found == {i: (x, False) for i, x in enumerate([False, True, False, False, True, False])}


def _expanded(text, pages):
    return expand.Expander(expand.Context(pages=pages.get)).expand(text)


def test_deep_expansion():
    for n in (50, 200, 500):
        assert _expanded("{{#if:x|" * n + "y" + "}}" * n, {}) == "y"
    assert _expanded("{{a|" * 200 + "y" + "}}" * 200, {"a": "<{{{1}}}>"}) == "<" * 200 + "y" + ">" * 200
    assert _expanded("[[ " * 300 + "{{a|y}}", {"a": "<{{{1}}}>"}) == "[[ " * 300 + "<y>"
    chain = {f"t{i}": f"{{{{t{i + 1}}}}}" for i in range(1, 200)}
    assert _expanded("{{t73}}", chain | {"t200": "end"}) == "end"
    for text in ("{{t72}}", "{{#if:x|" * 600 + "y" + "}}" * 600):
        with pytest.raises(expand.TemplateError, match="depth"):
            _expanded(text, chain | {"t200": "end"})


def test_long_expansion():
    long = "x" * 2_100_000 + "{{a}}"
    assert _expanded(long, {"a": "b"}) == long[:-5] + "b"
    assert _expanded("{{a}}" * 110_000, {"a": "b"}) == "b" * 110_000


def test_templates_of_the_table(spark, tmp_path):
    pages = [("1", 1, "2020-01-01T00:00:00Z", "P", 0, "{{box|1}} {{m|x|y}} {{lb|x|y}} {{no}}"), ("1", 2, "2020-01-01T00:00:00Z", "Template:box", 10, "old"), ("2", 3, "2020-01-02T00:00:00Z", "Template:box", 10, "<{{{1}}}>"), ("2", 4, "2020-01-01T00:00:00Z", "Template:m", 10, "M")]
    spark.createDataFrame(pages, "snapshot_id string, revision_id long, revision_timestamp string, title string, ns int, source string").write.parquet(f"{tmp_path}/bundle_pages.parquet")
    spark.createDataFrame([("P",)], "title string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.revision_id: r.expanded for r in core.QUERIES["pages_expanded"](spark, str(tmp_path)).collect()}
    assert got[1] == "<1> M (y) [[:Template:no]]"


def test_lemma_of_every_shape(spark, tmp_path):
    cases = ['{"de": {"language": "de", "value": "d"}, "en": {"language": "en", "value": "e"}}', '{"en": "plain"}', '[{"language": "ru", "value": "r"}, {"language": "ja", "value": "j"}]', '{"ja": {"language": "ja", "value": "j"}, "el": {"language": "el", "value": "g"}}', '"{\\"fr\\": \\"f\\"}"', "{}", "[]", None, '{"en": {"val', '{"en": null, "ar": "a"}']
    rows = [(i, x, None, None, None) for i, x in enumerate([*cases, cases[0]])] + [(0, cases[0], None, None, None)]
    spark.createDataFrame(rows, "capture_id long, lemmas string, claims string, forms string, senses string").write.parquet(f"{tmp_path}/wikibase.parquet")
    got = [(r.capture_id, r.language, r.value) for r in core.QUERIES["entity_lemma"](spark, str(tmp_path)).collect()]
    assert sorted(got) == [(0, "en", "e"), (1, "en", "plain"), (2, "ru", "r"), (3, "el", "g"), (4, "fr", "f"), (9, "ar", "a"), (10, "en", "e")]


def test_every_fallback_problem(spark, tmp_path):
    report = [(1, "a", "timeout"), (2, "b", "fallback"), (2, "b", "fallback"), (3, "c", None), (4, " ", "fallback"), (5, None, "fallback"), (6, "e", "expanded"), (6, "e", "expanded"), (7, "f", "fallback"), (99, "g", "timeout"), (8, "h", "fallback"), (8, "h", None)]
    spark.createDataFrame(report, "page_id long, title string, outcome string").write.parquet(f"{tmp_path}/bundle_expander.parquet")
    spark.createDataFrame([(i, 0) for i in range(1, 9)], "id long, ns int").write.parquet(f"{tmp_path}/pages.parquet")
    got = {tuple(r) for r in core.QUERIES["fallback_report_problems"](spark, str(tmp_path)).collect()}
    assert got == {
        (0, "a", "operational failure"), (0, "b", "repeated page"), (0, "b", "repeated reason"), (0, "c", "no reason"), (0, " ", "blank title"), (0, None, "blank title"),
        (None, "g", "operational failure"), (0, "h", "repeated page"), (0, "h", "no reason"),
    }


def test_samples_cards_and_main_members(spark, tmp_path):
    spark.createDataFrame([(i, i % 2, f"t{i}") for i in range(60)], "id long, ns int, title string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(1, "c")], "id long, title string").write.parquet(f"{tmp_path}/targets.parquet")
    spark.createDataFrame([(i, 1, 2, f"{i:03}", i) for i in range(60)], "link_id long, target long, kind int, sortkey string, from_id long").write.parquet(f"{tmp_path}/links.parquet")
    sample = core.QUERIES["reservoir_sample"](spark, str(tmp_path)).collect()
    assert len({r.id for r in sample}) == 10 and all(r.population == 30 and r.id % 2 == 0 for r in sample)
    cards = core.QUERIES["study_cards"](spark, str(tmp_path)).collect()
    assert cards and all(len(set(r.choices.split('|'))) == 4 and r.title in r.choices.split('|') for r in cards)
    main = core.QUERIES["category_members_main"](spark, str(tmp_path)).collect()
    assert sorted((r["rank"], r.from_id) for r in main) == [(i + 1, 2 * i) for i in range(30)]
