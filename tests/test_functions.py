"""Literal cases of the scalar functions and the wikitext readers."""

from __future__ import annotations

from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from lexmill.functions import collections as C
from lexmill.functions import dates as D
from lexmill.functions import numbers as N
from lexmill.functions import patterns, plurals, texts
from lexmill.functions import strings as S
from lexmill.functions import titles as T
from lexmill.functions import uris as U
from lexmill.functions.expression import expr, truth
from lexmill.wikitext import expand, scan


@pytest.mark.parametrize(
    ("text", "value"),
    [("6+329", "335"), ("-2^2", "4"), ("1e3", "1000"), ("2 < 3 and not 0", "1"), ("sqrt 9", "3"), ("3.14159 round 2", "3.14"), ("2^3^2", "64"), ("-7 mod 3", "-1"), ("", ""), ("1.005 round 2", "1"), ("(1+2)*3", "9"), ("7.5 fmod 2", "1.5"), ("1 = 1 or 0", "1"), ("trunc -2.7", "-2"), ("0 * -1", "0"), ("pi", "3.1415926535898"), ("1 &lt; 2", "1")],
)
def test_expressions(text, value):
    assert expr(text) == value


@pytest.mark.parametrize("text", ["1/0", "1 mod 0", "sqrt -1", "ln 0", "asin 2", "1 2", "foo", "(1", "1)", "+", "$", "9^9^9^9"])
def test_expression_errors(text):
    assert 'class="error"' in expr(text) and truth(text) is None


@pytest.mark.parametrize(
    ("pattern", "text", "found"),
    [("^(%w+)", "hello world", ["hello"]), ("(%w+)=(%w+)", "a=1", ["a", "1"]), ("^%s*(.-)%s*$", "  x ", ["x"]), ("%b()", "a(b(c)d)e", ["(b(c)d)"]), ("()ll()", "hello", ["3", "5"]), ("[%w%-%]]+", ".a-]b", ["a-]b"]), ("%f[%a]%a+", "1 abc", ["abc"]), ("x$", "axb", None), ("[^a-c]", "abcd", ["d"]), ("(.)%1", "hello", ["l"]), ("%S+", "é ü", ["é"])],
)
def test_patterns(pattern, text, found):
    assert patterns.match(text, pattern) == found


def test_gsub():
    assert patterns.gsub("hello", "l", "L", 1) == "heLlo"
    assert patterns.gsub("abc", "%w", "%0%0") == "aabbcc"
    assert patterns.gsub("$x$", "x", {"x": "1"}) == "$1$"
    assert patterns.gsub("abc", "b", "%%") == "a%c"
    with pytest.raises(patterns.PatternError):
        patterns.gsub("a", "(", "")


def test_plural_rules(tmp_path):
    # one form only, or no rules: the fallback chain, then English
    assert [plurals.form_index("1", "ja"), plurals.form_index("2", "ja"), plurals.form_index("2", "xx", ("ru",)), plurals.form_index("0", "xx", ("zh", "fr"))] == [0, 1, 1, 0]
    assert [plurals.form_index(x, "cy") for x in "0 1 2 3 6 4".split()] == [0, 1, 2, 3, 4, 5]
    for rules in plurals.RULES.values():
        for text in rules:
            plurals.rule(text)
    (tmp_path / "p.xml").write_text('<d><plurals><pluralRules locales="aa bb"><pluralRule count="one">n = 1 @integer 1</pluralRule><pluralRule count="other"> @integer 0</pluralRule></pluralRules></plurals></d>')
    assert plurals.load(str(tmp_path / "p.xml")) == {"aa": ["n = 1"], "bb": ["n = 1"]}
    assert [plurals.form_index(x, "ru") for x in ("1", "2", "5", "11", "21", "1.5")] == [0, 1, 2, 2, 0, 3]
    assert [plurals.form_index(x, "ar") for x in "0 1 2 5 11 100".split()] == [0, 1, 2, 3, 4, 5]
    assert plurals.form_index("1.0", "en") == 1 and plurals.operands("1e-3") is None
    assert plurals.plural("3", ["a", "b", "3=three"]) == "three" and plurals.plural("7", []) == ""
    with pytest.raises(NotImplementedError):
        plurals.gender(["a", "b"])


PAGES = {"a": "<noinclude>doc</noinclude>[{{{1|d}}}-{{{k|{{{2|z}}}}}}]", "loop": "x{{loop}}", "only": "a<onlyinclude>b</onlyinclude>c", "sec": "<section begin=x />S<section end=x />"}


@pytest.mark.parametrize(
    ("text", "result"),
    [
        ("{{a}}", "[d-z]"), ("{{a|q|k= v }}", "[q-v]"), ("{{only}}", "b"), ("{{nope|1}}", "[[:Template:nope]]"), ("{{#switch:b|a=1|b|c=2|#default=3}}", "2"), ("{{#switch:z|a=1|9}}", "9"), ("{{#switch:z|a=1|#default=4|9}}", "4"),
        ("{{#ifeq:1|1.0|y|n}}", "y"), ("{{#ifeq:a|A|y|n}}", "n"), ("{{#if: |y|n}}", "n"), ("{{#expr:1+{{#len:abc}}}}", "4"), ("{{#iferror:{{#expr:1/0}}|bad|ok}}", "bad"), ("{{#titleparts:a/b/c|1|2}}", "b"), ("{{#titleparts:a/b/c|-1}}", "a/b"),
        ("{{padleft:7|3}}", "007"), ("{{padright:ab|5|xy}}", "abxyx"), ("{{padleft:abcd|3}}", "abcd"), ("{{formatnum:1234567.8}}", "1,234,567.8"), ("{{formatnum:1,234|R}}", "1234"), ("{{plural:2|one|many}}", "many"), ("{{FULLPAGENAME}}", "Template talk:Foo/bar"),
        ("{{TALKPAGENAME}}|{{SUBPAGENAME}}|{{NAMESPACENUMBER}}", "Template talk:Foo/bar|bar|11"), ("{{#invoke:m|f|1|b=2}}", "{'1': '1', 'b': '2'}"), ("{{#sub:hello|1|-1}}", "ell"), ("{{#ifexist:a#x|E|N}}", "E"), ("[[x|{{a}}]]", "[[x|[d-z]]]"), ("{{{p}}}", "{{{p}}}"),
        ("{{{{#if:1|a|b}}|z}}", "[z-z]"), ("{{a|<nowiki>{{a}}</nowiki>}}", "[<nowiki>{{a}}</nowiki>-z]"), ("{{!}}", "|"), ("{{CURRENTYEAR}}-{{CURRENTMONTH}}", "2026-01"), ("{{lc:ÀB}}{{ucfirst:xy}}", "àbXy"), ("{{#lst:sec|x}}", "S"), ("{{#tag:ref|x|name=n}}", '<ref name="n">x</ref>'), ("{{urlencode:a b|WIKI}}", "a_b"), ("{{subst:a}}", "[d-z]"),
    ],
)
def test_expansion(text, result):
    context = expand.Context(title="Template talk:Foo/bar", pages=PAGES.get, exists=PAGES.__contains__, modules={"m": {"f": lambda args, parent: str(args)}}, now=datetime(2026, 1, 2, tzinfo=UTC))
    assert expand.Expander(context).expand(text) == result


def test_expansion_limits():
    loop = expand.Expander(expand.Context(pages=PAGES.get)).expand("{{loop}}")
    assert "Template loop" in loop
    with pytest.raises(expand.TemplateError):
        expand.parse_template("a|" + "|".join("x" * 17_000))
    assert "not registered" in expand.Expander(expand.Context()).expand("{{#invoke:x|y}}")
    deep = "{{a|" * 300 + "}}" * 300
    assert isinstance(expand.Expander(expand.Context(pages=PAGES.get)).expand(deep), str)


def test_references():
    found = expand.references("{{a|{{b}}}} {{#invoke:m|f}} {{{{{1}}}}} {{{{#if:x|p|q}}}} {{PAGENAME}} <!-- {{c}} --> {{subst:d}} <nowiki>{{e}}</nowiki>")
    assert set(found["refs"]) >= {("template", "a"), ("template", "b"), ("module", "m"), ("template", "d")} and ("template", "c") not in found["refs"] and ("template", "e") not in found["refs"]
    assert found["dynamic_template"] and not found["dynamic_module"]
    assert expand.references("{{ {{#if:x|p|q}} }}")["refs"] == [("template", "p"), ("template", "q")]


def test_scanning():
    assert scan.heading("=== Head ====") == (3, "Head =") and scan.heading("======= Head =======") == (6, "= Head =") and scan.heading("a = b") is None
    assert scan.sections("i\n==English==\nx\n===Noun===\ny\n==French==\nz") == [(0, 0, "", "i\n"), (1, 2, "English", "x\n===Noun===\ny\n"), (2, 2, "French", "z")]
    assert scan.emphasis("a ''b'' '''open") == [("a ", False, False), ("b", False, True), (" '''open", False, False)]
    assert scan.links("[[cat]]s [[a|b]]")[0] == {"target": "cat", "label": "cats", "piped": False, "trail": "s"}
    assert scan.categories("[[Category:X|k]] {{t|[[Category:Y]]}}") == [{"name": "X", "sortkey": "k"}]
    assert scan.table_grid([[(1, 2), (2, 1)], [(1, 1)]]) == {"rows": 2, "columns": 3, "widest": 2, "deepest": 2} and scan.table_grid([[(101, 1)]]) is None
    assert scan.cell_places([[(1, 2), (2, 1)], [(1, 1)]]) == [[0, 1], [1]]
    assert [scan.classify_line(x)[:2] for x in ("# a", "## a", "#: a", "#* a", "* a", "*: a", "; a", ": a", "a", "")] == [("definition", 1), ("definition", 2), ("example", 2), ("quotation", 2), ("list_item", 1), ("list_detail", 2), ("term", 1), ("indent", 1), ("paragraph", 0), ("blank", 0)]
    assert scan.balanced("x {{a|[[b]]}} y", 2) == (2, 13, "{{") and scan.balanced("{{a", 0) is None
    assert scan.split_top("a|{{b|c}}|[[d|e]]|f", "|") == ["a", "{{b|c}}", "[[d|e]]", "f"]
    assert scan.matching_tag("<b><b>x</b></b>", 0) == (11, 15) and scan.line_break("<br/>")


def test_text_functions():
    assert texts.xml_decode("&amp;lt;") == "&lt;" and texts.xml_decode("&amp;lt;", True) == "<" and texts.xml_decode("&#x41;&#0;&foo;") == "A&#0;&foo;"
    assert texts.html_decode("&amp;&hellip;") == "&&hellip;" and texts.html_decode("&hellip;", True) == "…"
    assert texts.utf8_repaired(b"\xe2\x82A\xffz") == "��A�z"
    assert expand.strip_comments("a\n<!-- x -->\nb<!-- y -->c") == "a\nbc"
    assert expand.own("<includeonly>x</includeonly><noinclude>y</noinclude>") == "y" and expand.transcluded("<includeonly>x</includeonly><noinclude>y</noinclude>") == "x"


def one(spark, *columns):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def test_string_columns(spark):
    x = F.lit("École")
    row = one(spark, S.byte_len(x), S.usub(x, 2, -2), S.byte_offset(x, 2), S.truncate(x, 2), S.fill_message(F.lit("$1-$2-$3"), F.lit("$2"), F.lit("b")), S.list_to_text(F.array(F.lit("a"), F.lit("b"), F.lit("c"))), S.byte_at(x, 1), S.first_upper_in(F.lit("ix"), "tr"), S.kill_markers(F.lit("a\x7f'\"`UNIQ-x-QINU`\"'\x7fb")))
    assert list(row) == [6, "col", 3, "Éc…", "$2-b-$3", "a, b and c", 0xC3, "İx", "ab"]
    assert S.byte_char(65, 66) is not None
    nulls = one(spark, *[f(F.lit(None).cast("string")) for f in (S.byte_len, S.byte_lower, S.ulen, S.html_encode, S.first_upper, S.category_key, S.format_number, S.codepoints)])
    assert list(nulls) == [None] * 8


def test_number_and_date_columns(spark):
    now = F.lit("2026-11-26 10:00:00").cast("timestamp")
    row = one(spark, S.format_number(F.lit("-1234567.5")), S.format_number(F.lit("x1")), N.round_half_up(F.lit(1.005), 2), N.to_number(F.lit("ff"), 16), N.same_number(F.lit("1"), F.lit("01.0")), N.to_text(F.lit(0.1)), D.format_date(D.parse_date(F.lit("3/4/69"), now), "Y-m-d"), D.format_date(D.parse_date(F.lit("last day of last month"), now), "j F"), D.os_date(now, "%Y-%j %H"))
    assert list(row) == ["−1,234,567.5", "x1", 1.0, 255.0, True, "0.1", "2069-03-04", "31 October", "2026-330 10"]
    assert one(spark, D.parse_date(F.lit("31.2.2020"), now))[0] is None
    assert list(one(spark, D.iso_weeks_in_year(F.lit(2026)), D.iso_weeks_in_year(F.lit(2025)))) == [53, 52]


def test_collections(spark):
    a = F.array(F.lit(3), F.lit(1), F.lit(None), F.lit(2))
    row = one(spark, C.remove(a, 2), C.until_null(a), C.select(a, -2), C.insert(a, F.lit(9), 1), C.max_key(F.create_map(F.lit(2), F.lit("x"), F.lit(-7), F.lit("y"))), C.json_decode(F.lit('{"a":[1,],}'), True).cast("string"), C.json_sequences(F.lit('{"1":5,"2":{"a":1}}')), C.localized(F.lit('{"en":"x"}'), ["fr", "en"]))
    assert list(row) == [[3, None, 2], [3, 1], [None, 2], [9, 3, 1, None, 2], 2, '{"a":[1]}', '[5,{"a":1}]', "x"]


def test_uris_and_titles(spark):
    p = U.parts(F.lit("https://u@h.example:80/a?x=1&x=3#f"))
    row = one(spark, p["host"], p["port"], U.to_text(p), U.query_map(p["query"])["x"], U.encode(F.lit("a b/é"), "WIKI"), U.decode(F.lit("a+b"), "PATH"), U.decode(F.lit("%zz")), U.anchor_encode(F.lit("a  [[b|c]] &amp;")), U.is_external_url(F.lit("http://x y")))
    assert list(row) == ["h.example", 80, "https://u@h.example:80/a?x=1&x=3#f", ["1", "3"], "a_b/%C3%A9", "a+b", None, "a_c_&", False]
    names = {"vorlage": (10, "Vorlage", "first-letter"), "template": (10, "Vorlage", "first-letter"), "benutzer": (2, "Benutzer", "first-letter"), "user": (2, "Benutzer", "first-letter")}
    assert T.normalized("Template:Foo", names, 10) == (10, "Vorlage:Foo")
    assert T.normalized("Template:Template:nested", names, 10)[1] == "Vorlage:Nested" or T.normalized("Template:Template:nested", names, 10)[1] == "Vorlage:nested"
    assert T.normalized("User:école", names) == (2, "Benutzer:École") and T.normalized(":plain", names, 10) == (0, "plain") and T.normalized(" _ ", names) is None
    row = one(spark, T.is_valid(F.lit("a<b")), T.is_valid(F.lit("a/../b")), T.is_valid(F.lit("é" * 128)), T.is_valid(F.lit("ok")), T.title_parts(F.lit("a/b/c"), 1, 2), T.media_kind(F.lit("x.SVG")), T.media_kind(F.lit("x.SVG"), True), T.redirect_tail(F.lit("#REDIRECT [[animus]]")), T.redirect_tail(F.lit("<!-- [[wrong]] -->#REDIRECT [[right]]")), T.media_type(F.lit(b"\x89PNG\r\n\x1a\n").cast("binary")))
    assert list(row) == [False, False, False, True, "b", None, "image", "", None, "image/png"]
