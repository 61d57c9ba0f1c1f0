"""The readers of wikitext over entries of a known shape, one for each page title, with their SQL.

The shape is fixed, the titles are all those of the table: what a reader must
find can so be said in SQL, while the words in it come in every script.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.functions import texts as X
from lexmill.operators import entries
from lexmill.operators import sequences as Q
from lexmill.plans.core import query
from lexmill.plans.scalars import _P, _pages

ENTRY = (
    "intro @\n==English==\n===Etymology===\nfrom @\n===Noun===\n# @ one\n#: example @\n#* quoted @\n## deeper @\n# second\n===See also===\n"
    "* [[Page @|shown]]s ''it'' '''bold''' [https://x.example/a label] [[Category:@|key]]\n==French==\n===Verb===\n# @\n"
)


def _filled(text: str):
    parts = []
    for i, piece in enumerate(text.split("@")):
        parts += [F.col("title")] * (i > 0) + [F.lit(piece)]
    return F.concat(*parts)


def _rows(s, d, text: str = ENTRY):
    return _pages(s, d).select("id", "title", F.lit("en").alias("language"), _filled(text).alias("source"))


def _sql(text: str) -> str:
    """SQL of a text with the title in place of each ``@``."""
    return " || ".join(f"'{x}'" if i % 2 == 0 else "title" for i, x in enumerate("@".join(x.replace("'", "''") for x in text.split("@")).replace("@", "\x00@\x00").split("\x00"))).replace("\n", "' || chr(10) || '")


_ENGLISH = ENTRY.split("==English==\n")[1].split("==French==")[0]


@query(f"""select id, title, ord, level, heading, source from (select id, title, 0 as ord, 0 as level, '' as heading, {_sql("intro @" + chr(10))} as source from {_P}
  union all select id, title, 1, 2, 'English', {_sql(_ENGLISH)} from {_P} union all select id, title, 2, 2, 'French', {_sql("===Verb===" + chr(10) + "# @" + chr(10))} from {_P})""")
def shape_sections(s, d):
    return Q.section_rows(_rows(s, d), ["id", "title"], "source", (1, 2))


@query(f"""select id, title, 'en' as language, 0 as first_ord, {_sql("intro @" + chr(10) + chr(10) + _ENGLISH)} as source from {_P} union all select id, title, 'fr', 2, {_sql("===Verb===" + chr(10) + "# @" + chr(10))} from {_P}""")
def shape_languages(s, d):
    """The text before the first language goes with it."""
    names = s.createDataFrame([("English", "en"), ("French", "fr")], "name string, code string")
    sections = Q.section_rows(_rows(s, d), ["id", "title"], "source", (1, 2))
    return Q.language_groups(Q.resolved_languages(sections, ["id", "title"], names, "und"), ["id", "title"])


_LINES = "(values (5, 'definition', 1, null, null), (6, 'example', 2, null, 5), (7, 'quotation', 2, null, 5), (8, 'definition', 2, 5, null), (9, 'definition', 1, null, null), (11, 'list_item', 1, null, null), (14, 'definition', 1, null, null))"


@query(f"""select id, title, l.* from {_P} p, (select col0 as ord, col1 as kind, col2 as depth, col3::int as parent, col4::int as sense from {_LINES}) l""")
def shape_senses(s, d):
    return Q.sense_layout(Q.blocks(_rows(s, d), ["id", "title"], "source"), ["id", "title"]).where("depth > 0")


@query(f"""select id, title, l.* from {_P} p, (select col0 as ord, col1 as heading, col2 as pos, col3 as kind from (values (1, 'Etymology 1', null, 'etymology'), (2, 'Noun', 'Noun', null), (3, 'Synonyms', null, 'relations'), (4, 'Usage notes', null, null), (5, 'Verb 2', 'Verb', null))) l""")
def shape_headings(s, d):
    text = "===Etymology 1===\nfrom @\n===Noun===\n# @\n===Synonyms===\n* @\n===Usage notes===\n@\n===Verb 2===\n# @"
    rows = Q.section_rows(_rows(s, d, text), ["id", "title"], "source", (3,))
    return rows.select("id", "title", "ord", "heading", Q.part_of_speech(F.col("heading")).alias("pos"), Q.section_kind(F.col("heading")).alias("kind"))


_LEXEMES = """(values (0, 0, '', null, null, null, null), (1, 2, 'English', null, null, null, null), (2, 3, 'Etymology', null, 'etymology', 2, null), (3, 3, 'Noun', 'Noun', null, 2, 3),
  (4, 3, 'See also', null, 'relations', 2, null), (5, 2, 'French', null, null, null, null), (6, 3, 'Verb', 'Verb', null, null, 6))"""


@query(f"""select id, title, l.* from {_P} p, (select col0 as ord, col1 as level, col2 as heading, col3 as pos, col4 as kind, col5::int as etymology, col6::int as lexeme from {_LEXEMES}) l""")
def shape_lexemes(s, d):
    """Parts of speech with the etymology in force, which the next language ends."""
    return Q.lexemes(Q.heading_rows(_rows(s, d), ["id", "title"], "source"), ["id", "title"])


@query(f"""select id, title, true as valid, 'en' as language, 7 as n_sections, 9 as n_blocks, 2 as n_lexemes, 'Noun,Verb' as speech, 3 as n_definitions, 2 as etymology, 0 as parent, '1' as examples, '2' as quotations, '0,1,2,4,5' as others, 'shown' || 's' as link_text, 'Page ' || title as link_target, true as italic, true as bold,
  'https://x.example/a' as url, {_sql("intro @" + chr(10) + "## English" + chr(10) + "## Etymology" + chr(10) + "from @" + chr(10) + "## Noun" + chr(10) + "@ one" + chr(10) + "  example @" + chr(10) + "  quoted @" + chr(10) + "  deeper @" + chr(10) + "second" + chr(10) + "## See also" + chr(10) + "shows it bold label ".replace("shows", "showns") + chr(10) + "## French" + chr(10) + "## Verb" + chr(10) + "@")} as text from {_P}""")
def shape_entries(s, d):
    """Sections, lexemes and senses of the compiled entries, and their text."""
    e = F.col("entry")
    noun, also = e["lexemes"][0], e["sections"][4]["blocks"][0]["spans"]
    ints = lambda xs: F.array_join(F.transform(xs, lambda x: x.cast("string")), ",")
    found = lambda test: F.exists(also, test)
    m = entries.metrics(e)
    return entries.compiled(_rows(s, d), ["id"]).select(
        "id", e["title"].alias("title"), entries.is_valid(e).alias("valid"), e["language"].alias("language"), m["n_sections"].alias("n_sections"), m["n_blocks"].alias("n_blocks"), F.size(e["lexemes"]).alias("n_lexemes"), F.array_join(F.transform(e["lexemes"], lambda x: x["kind"]), ",").alias("speech"),
        F.size(noun["definitions"]).alias("n_definitions"), noun["etymology"].alias("etymology"), noun["definitions"][1]["parent"].alias("parent"), ints(noun["definitions"][0]["examples"]).alias("examples"), ints(noun["definitions"][0]["quotations"]).alias("quotations"),
        ints(e["other_sections"]).alias("others"), also[0]["text"].alias("link_text"), also[0]["target"].alias("link_target"), found(lambda x: x["italic"] & (x["text"] == "it")).alias("italic"), found(lambda x: x["bold"] & (x["text"] == "bold")).alias("bold"),
        F.array_join(F.transform(F.filter(also, lambda x: x["kind"] == "external"), lambda x: x["target"]), ",").alias("url"), entries.plain_text(e).alias("text"),
    )


@query(f"""select id, title, 'Page ' || title as target, 'lab' || 's' as label, 's' as trail, 'https://x.example/a' as url, 'text' as url_label, 'https://free.example/b' as free, title as category, 'k' as sortkey, 't' as template, 2 as n_params, 3 as level, title as heading, 'a ' as plain, title as italic, 'm' as name, title as second, 'v' as named,
  '&#91;&#91;' || replace(title, chr(39), '&#39;') || '&#93;&#93;' as nowiki, title || 'y' as included, title as bare from {_P}""")
def shape_marks(s, d):
    """Links, categories, templates, headings and emphasis around every title."""
    whole = _filled("[[Page @|lab]]s [https://x.example/a text] https://free.example/b {{t|@|k=v}} [[Category:@|k]]")
    rows = _pages(s, d)
    first = lambda xs: xs[0]
    link, outer, category, template = first(X.links_column(whole)), first(X.external_links_column(whole)), first(X.categories_column(whole)), first(X.templates_column(whole))
    emphasis, call, heading = X.emphasis_column(_filled("a ''@''")), X.template_column(_filled("m|fr|@|k= v ")), X.heading_column(_filled("=== @ ==="))
    rows = rows.select("id", "title", link.alias("l"), outer.alias("o"), first(X.free_urls_column(whole)).alias("free"), category.alias("c"), template.alias("t"), emphasis.alias("e"), call.alias("p"), heading.alias("h"), X.nowiki_column(_filled("[[@]]")).alias("nowiki"), X.transcluded_column(_filled("@<noinclude>x</noinclude><includeonly>y</includeonly>")).alias("included"), X.comments_stripped_column(_filled("@<!-- @ -->")).alias("bare"))
    params = F.col("p.params")
    return rows.select(
        "id", "title", "l.target", "l.label", "l.trail", "o.url", F.col("o.label").alias("url_label"), "free", F.col("c.name").alias("category"), "c.sortkey", F.col("t").getField("name").alias("template"),
        F.col("t.n_params").alias("n_params"), "h.level", F.col("h.title").alias("heading"), F.col("e")[0]["text"].alias("plain"), F.col("e")[1]["text"].alias("italic"), F.col("p.name").alias("name"), params[1]["value"].alias("second"), params[2]["value"].alias("named"), "nowiki", "included", "bare",
    )


@query(f"""select id, title, '<div title="' || replace(replace(replace(replace(replace(title, '&', '&amp;'), '"', '&quot;'), '<', '&lt;'), '>', '&gt;'), '''', '&#x27;') || '" class="a" style="color:red"><b>' || title || '</b><br /></div>' as html from {_P}""")
def shape_html(s, d):
    from lexmill.functions.lazy import mapped
    from lexmill.wikitext import builder

    def built(title: str) -> str:
        root = builder.create("div").add_class("a").css("color", "red").attr("title", title)
        root.tag("b").wikitext(title).done().tag("br")
        return str(root)

    return _pages(s, d).select("id", "title", mapped(built, "string", F.col("title")).alias("html"))


@query(f"""select id, kind, target, dynamic_template, dynamic_module from (select id, 'template' as kind, regexp_replace(title, '^Template:', '') as target, false as dynamic_template, false as dynamic_module from {_P} union all select id, 'module', title, false, false from {_P} union all select id, 'template', 'p', false, false from {_P} union all select id, 'template', 'q', false, false from {_P})""")
def shape_references(s, d):
    """Templates and modules named outright, or by a test with plain branches; comments and hidden text name none."""
    from lexmill.operators import graphs

    text = "{{@|x}} {{#invoke:@|f}} {{ {{#if:@|p|q}} }} <!-- {{no}} --> <nowiki>{{no}}</nowiki> {{{no}}} {{PAGENAME}}"
    return graphs.references(_rows(s, d, text), ["id"], "source")
