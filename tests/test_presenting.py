"""Presentation of templates, dates of the parser functions, languages declared in pages."""

from __future__ import annotations

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from lexmill.functions import numbers as N
from lexmill.functions import strings as S
from lexmill.operators import resolution
from lexmill.sources import tsv
from lexmill.wikitext import clock, compiling, expand, presenting

NOW = datetime(2026, 3, 31, 12, 30, tzinfo=UTC)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2020-02-29", "2020-02-29 00:00:00"), ("2020-02-29T23:59:59-05:00", "2020-03-01 04:59:59"), ("29.2.2020", "2020-02-29 00:00:00"), ("2/29/20", "2020-02-29 00:00:00"), ("29 Feb 2020", "2020-02-29 00:00:00"), ("February 29, 2020", "2020-02-29 00:00:00"),
        ("Feb 2020", "2020-02-01 00:00:00"), ("-1 month", "2026-02-28 12:30:00"), ("2 days ago", "2026-03-29 12:30:00"), ("last day of next month", "2026-04-30 00:00:00"), ("tomorrow", "2026-04-01 00:00:00"), ("@86400", "1970-01-02 00:00:00"), ("20200229010203", "2020-02-29 01:02:03"),
        ("07:05", "2026-03-31 07:05:00"), ("2021-02-29", None), ("soon", None), ("1 Foo 2020", None), ("99:99", None),
    ],
)
def test_reading_dates(text, expected):
    at = clock.read(text, NOW)
    assert (at and f"{at:%Y-%m-%d %H:%M:%S}") == expected


def test_formats():
    at = datetime(2024, 12, 30, 0, 5, 9, tzinfo=UTC)
    assert clock.formatted(at, 'D j M y, g:i a "at" \\Y Y W o z t L N w U c') == "Mon 30 Dec 24, 12:05 am at Y 2024 01 2025 364 31 1 1 1 1735517109 2024-12-30T00:05:09+00:00"
    assert clock.preferred("x", "dmy", NOW) == "x" and ">31 March 2026<" in clock.preferred("2026-03-31", "dmy", NOW)


def _text(body, title="T"):
    spans = presenting.presented(body, title)
    return None if spans is None else "".join(s["text"] for s in spans)


@pytest.mark.parametrize(
    ("body", "shown"),
    [
        ("lb|en|3=c|2=b|2=B", "(B, c)"), ("m|fr|a<alt:b><q:c>", "b (c)"), ("l|fr|a<i>b</i>", "a<i>b</i>"), ("en-noun|cats", "T · noun (plural cats)"), ("head|fr|verb|g=m", "T · verb (m)"), ("quote-web|en", None), ("syn|en", "Synonyms: "),
        ("inh|en|ang|-", "Old English"), ("w", "T"), ("senseid|en|x", ""), ("past of|en|go||leave", "past tense of go (“leave”)"), ("nothing|x", None), ("t+|de|Haus|n|tr=x", "Haus n (x)"), ("IPAchar|/a/|a=UK", "/a/ (UK)"),
    ],
)
def test_presented(body, shown):
    assert _text(body) == shown


def test_compiled_templates():
    entry = compiling.compile_page("# ''see {{m|fr|chat|t=a [[cat]]}}'' {{lb|en|{{l|fr|x}}}} {{own|y}}\n# {{syn|en|b|c}}\n<pre>\n== no ==\n</pre>\n# last", "T", "language", "en")
    blocks = entry["sections"][0]["blocks"]
    assert [compiling.plain(b["spans"]) for b in blocks][:2] == ["see chat (“a cat”) (x) {{own|y}}", "Synonyms: b, c"]
    first = blocks[0]["spans"]
    assert [(x["text"], x["target"], x["italic"]) for x in first if x["kind"] == "link"] == [("chat", "chat", True), ("cat", "cat", True), ("x", "x", False)]
    assert entry["fallbacks"] == ["unexpanded-template"] and len(entry["sections"]) == 1 and blocks[-1]["kind"] == "definition"
    assert compiling.compile_page("{{q|" * 300 + "x" + "}}" * 300, "T", "language", "en")["fallbacks"] == ["unexpanded-template"]


def test_site_functions():
    context = expand.Context(title="P", language="de", messages=lambda code, key: {("en", "m"): "a $1 {{lc:B}} $2"}.get((code, key)), tree=lambda c: {"a": ["b", "a"], "b": ["c"]}.get(c, []), interwiki={"here": "local"}, pages={"t": "x"}.get)
    run = lambda text: expand.Expander(context).expand(text)
    assert run("{{int:M|v}}") == "a v b $2" and run("{{int:zz}}") == "⧼zz⧽"
    assert run("{{#categorytree:Category:a|depth=3}}") == '<ul class="CategoryTree"><li>[[:Category:a|a]]<ul><li>[[:Category:b|b]]<ul><li>[[:Category:c|c]]</li></ul></li><li>[[:Category:a|a]]</li></ul></li></ul>'
    assert run("{{here:t}}") == "x" and run("{{localurl:a b|x=1}}") == "/w/index.php?title=a_b&amp;x=1"
    assert "Unknown extension tag" in run("{{#tag:nope|x}}") and run("{{#time:Y|2020-01-01}}") == "2020"


def test_formats_of_values(spark):
    row = spark.range(1).select(
        S.format_string("%5d|%-5s|%05.1f|%g|%q|%c|%i%%", F.lit(42), F.lit("ab"), F.lit(3.14159), F.lit(0.0001), F.lit('a"b\\\n'), F.lit(65), F.lit(7)), S.direction(F.lit("ar-latn")), S.arrow(F.lit("forwards"), F.lit("he")), S.simple_fold(F.lit("ßÀΣİ")), N.random_between(1, "id", low=3, high=5),
        resolution.marker_language(F.lit("{{-fr-}}")), resolution.marker_language(F.lit("{{=-}}")), resolution.declared_language(F.lit("لغة  x "), "ar"),
    ).first()
    assert row[0] == '   42|ab   |003.1|0.0001|"a\\"b\\\\\\\n"|A|7%'
    assert row[1] == "ltr" and row[2] == "←" and row[3] == "ßàσİ" and 3 <= row[4] <= 5 and row[5:] == ("fr", None, "x")
    with pytest.raises(ValueError):
        S.format_string("%d")
    with pytest.raises(ValueError):
        S.format_string("%y", F.lit(1))


def test_small_tables(spark, tmp_path):
    (tmp_path / "c.tsv").write_text("# head\na\t5\t2\t1\nb\t1\t0\t0\n")
    assert {tuple(r) for r in tsv.category_stats(spark, str(tmp_path / "c.tsv")).collect()} == {("a", 5, 2, 1), ("b", 1, 0, 0)}
    (tmp_path / "d.tsv").write_text("a\t1\t2\t1\n")
    with pytest.raises(Exception, match="counts of a"):
        tsv.category_stats(spark, str(tmp_path / "d.tsv")).collect()
    (tmp_path / "r.tsv").write_text("a\tb\na\tc\n")
    with pytest.raises(Exception, match="repeated a"):
        tsv.redirect_overrides(spark, str(tmp_path / "r.tsv")).collect()
    (tmp_path / "i.tsv").write_text("W\thttps://w/$1\ttrue\tfalse\tfalse\n")
    assert tsv.interwiki_map(spark, str(tmp_path / "i.tsv")).first().prefix == "w"
    edges = spark.createDataFrame([("t", "a\tb", "c\\\nd")], "kind string, source string, target string")
    assert tsv.usage_edges(edges).first()[0] == "t\ta\\tb\tc\\\\\\nd"
