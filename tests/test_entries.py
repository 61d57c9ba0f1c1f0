"""Entries, resolution, snapshots, HTML elements and streams on small inputs."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lexmill.operators import entries, resolution
from lexmill.operators import sequences as Q
from lexmill.sources import snapshots
from lexmill.streaming import recency as stream
from lexmill.wikitext import builder, compiling

SOURCE = "==English==\n===Etymology===\nFrom ''x''<ref name=a>R</ref>.\n===Noun===\n# [[one]]s\n#: ex\n## '''two'''\n#* q\n{|\n! h\n|-\n| [[c|d]] || e\n|}\n====Synonyms====\n* s\n==French==\n[[File:a.png|thumb|cap]] again<ref name=a />"


def test_entries(spark):
    pages = spark.createDataFrame([(1, "t", "en", SOURCE), (2, "u", None, ""), (3, "v", "en", None), (4, "w", "en", "{{own}} {|")], "id long, title string, language string, source string")
    got = {r.id: r.entry for r in entries.compiled(pages, ["id"]).collect()}
    assert got.keys() == {1, 2, 4}
    e = got[1]
    assert [s.title for s in e.sections] == ["English", "Etymology", "Noun", "Synonyms", "French"]
    assert [(x.kind, x.section, x.etymology) for x in e.lexemes] == [("Noun", 2, 1)]
    assert [(d.block, d.parent, d.examples, d.quotations) for d in e.lexemes[0].definitions] == [(0, None, [1], [3]), (2, 0, [], [])]
    assert [(r.number, r.name) for r in e.references] == [(1, "a")] and [(m.file, m.kind, m.caption) for m in e.media] == [("a.png", "image", "cap")]
    assert e.other_sections == [0, 1, 4] and got[4].fallbacks == ["unexpanded-template"]
    df = entries.compiled(pages, ["id"])
    assert [r[0] for r in df.where("id = 1").select(entries.is_valid(F.col("entry"))).collect()] == [True]
    text = df.where("id = 1").select(entries.plain_text(F.col("entry"))).first()[0]
    assert "## Noun\nones\n" in text and "\n  two" in text
    assert df.where("id = 1").select(entries.metrics(F.col("entry")).alias("m")).first().m.n_tables == 1
    bad = df.where("id = 1").withColumn("entry", F.col("entry").withField("other_sections", F.array(F.lit(99))))
    assert bad.select(entries.is_valid(F.col("entry"))).first()[0] is False
    assert compiling.spans("a [[b|c]] <br> [http://x y] <code>z</code>")[1]["target"] == "b"


def test_resolution(spark):
    registry = spark.createDataFrame([("en", "canonical", "English", True), ("en", "code", "en", True), ("ang", "canonical", "Old English", False), ("xx", "alias", "english", False), ("yy", "canonical", "Same", True), ("zz", "canonical", "Same", True)], "code string, kind string, name string, trusted boolean")
    names = spark.createDataFrame([("ENGLISH",), ("Old_English",), ("en",), ("?",)], "name string")
    assert {r.name: (r.code, r.heading) for r in resolution.languages(names, registry).collect()} == {"ENGLISH": ("en", "English"), "Old_English": ("ang", "Old English"), "en": ("en", "English"), "?": (None, None)}
    assert {r.name for r in resolution.languages(names, registry, True).where("code is not null").collect()} == {"ENGLISH", "en"}
    assert {r.code for r in resolution.strong_languages(registry).collect()} == {"en", "ang"}
    spaces = spark.createDataFrame([(10, "Vorlage", "Template"), (0, "", "")], "id int, name string, canonical_name string")
    titles = spark.createDataFrame([("template:a",), ("x:y",), ("plain",)], "title string")
    assert {(r.title, r.ns, r.rest) for r in resolution.namespaces(titles, spaces).collect()} == {("template:a", 10, "a"), ("x:y", 0, "x:y"), ("plain", 0, "plain")}
    known = spark.createDataFrame([("de", "m", "V", "D"), ("en", "m", "V", "E"), ("bar", "m", "M", "")], "language string, message string, state string, text string")
    chains = spark.createDataFrame([("bar", ["de", "en"])], "code string, chain array<string>")
    asked = spark.createDataFrame([("bar", "m"), ("fr", "m")], "language string, message string")
    assert {(r.language, r.text, r.source) for r in resolution.messages(asked, known, chains).collect()} == {("bar", "D", "de"), ("fr", None, None)}
    cards = resolution.study_cards(spark.createDataFrame([(c,) for c in "abcdef"], "title string"), 4, 1, 6).collect()
    assert len(cards) == 6 and all(len(set(r.choices)) == 4 and r.title in r.choices for r in cards)
    order = resolution.edition_order(spark.createDataFrame([(w,) for w in ("b", "en", "a", "p")], "wiki string"), ["p"], "en")
    assert [r.wiki for r in order.collect()] == ["p", "en", "a", "b"]
    raw = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], "id long, ord int, heading string")
    shown = spark.createDataFrame([(1, 5, "A"), (1, 6, "B"), (2, 0, "C"), (2, 1, "D")], "id long, ord int, heading string")
    assert {(r.id, r.raw_heading, r.rendered_heading, r.aligned) for r in resolution.aligned_sections(raw, shown, ["id"]).collect()} == {(1, "a", "A", True), (1, "b", "B", True), (2, "c", "C", False), (2, None, "D", False)}
    links = spark.createDataFrame([("Q1", "enwiki", "One"), ("Q1", "dewiki", "Eins")], "entity string, site string, title string")
    assert {tuple(r) for r in resolution.sitelinks(spark.createDataFrame([("Q1",), ("Q2",)], "entity string"), links, "dewiki").collect()} == {("Q1", "Eins"), ("Q2", None)}


def test_snapshots(spark):
    redirect = spark.createDataFrame([(1, 0, "A_b", None, "x")], "rd_from long, rd_namespace int, rd_title string, rd_interwiki string, rd_fragment string")
    assert snapshots.redirect_rows(redirect).first()[:] == (1, 0, "415f62", "", "78")
    with pytest.raises(Exception, match="repeated redirect"):
        snapshots.redirect_rows(redirect.union(redirect)).collect()
    site, iso = spark.createDataFrame([("en", "English")], "code string, name string"), spark.createDataFrame([("en", "English"), ("en", "Anglic"), ("q", "Q")], "code string, name string")
    assert {tuple(r) for r in snapshots.language_registry(site, iso).collect()} == {("canonical", "en", "English"), ("alias", "en", "Anglic"), ("code", "en", "en")}
    files = spark.createDataFrame([("a", '{"missing":true}'), ("b", '{"imageinfo":[{"width":3,"height":4,"mime":"image/png"}]}')], "file string, document string")
    assert [tuple(r) for r in snapshots.file_rows(files).orderBy("file").collect()] == [("a", "missing", None, None, None), ("b", "present", 3, 4, "image/png")]
    table = json.dumps({"schema": {"fields": [{"name": "n", "type": "number"}, {"name": "t", "type": "localized"}]}, "data": [[1, {"en": "x"}]]})
    assert [tuple(r) for r in snapshots.tabular_data(spark.createDataFrame([("d", table)], "name string, document string"), ["de", "en"]).collect()] == [("d", 0, "n", "1"), ("d", 0, "t", "x")]
    one = spark.createDataFrame([("a",)], "title string")
    assert snapshots.merged_captures([one], "title", one).count() == 1
    with pytest.raises(Exception, match="not captured once"):
        snapshots.merged_captures([one, one], "title", one).collect()
    page = spark.createDataFrame([(1, "A_b")], "page_id long, page_title string")
    props = spark.createDataFrame([(1, "wikibase_item", "Q1"), (1, "x", "y")], "pp_page long, pp_propname string, pp_value string")
    assert snapshots.page_links(page, props).first()[:] == ("A b", "Q1")
    said = spark.createDataFrame([("en", '[{"name":"a","content":"x"},{"name":"b","missing":""}]')], "language string, document string")
    assert {tuple(r) for r in snapshots.message_rows(said).collect()} == {("en", "a", "V", "x"), ("en", "b", "M", "")}
    spaces = spark.createDataFrame([(0, "x")], "id int, name string")
    with pytest.raises(Exception, match="one side only"):
        snapshots.namespace_registry(spaces, spaces.where("false")).collect()


def test_builder():
    root = builder.create("div").add_class("a").add_class("b a").css("color", "red").attr("id", 'x"')
    root.tag("br").done().tag("b").wikitext("y", None, "z").newline()
    assert str(root) == '<div id="x&quot;" class="a b" style="color:red"><br /><b>y\n</b></div>'
    assert root.get_attr("class") == "a b" and root.children[1].all_done() is root
    with pytest.raises(ValueError):
        builder.create("a b")


def test_stream_equals_batch(spark, sf, tmp_path):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "e.parquet").symlink_to(f"{sf}/events.parquet")
    events = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    columns = ("user_id", "event_type", "ts")
    out, whole = str(tmp_path / "out"), spark.read.parquet(f"{sf}/events.parquet")
    stream.keep_recent(events, out, *columns).awaitTermination(120)
    want = {tuple(r) for r in Q.recency(whole, "user_id", "event_type", ["ts"], 3).collect()}
    assert {tuple(r) for r in stream.recent(spark, out, *columns, 3).collect()} == want
    # more events come later: another batch is added to what is there
    whole.where("event_id < 100").write.parquet(str(tmp_path / "more"))
    for i, file in enumerate((tmp_path / "more").glob("*.parquet")):
        file.rename(tmp_path / "in" / f"more{i}.parquet")
    stream.keep_recent(events, out, *columns).awaitTermination(120)
    assert stream.last_visits(spark, out, *columns).agg(F.sum("n_visits")).first()[0] == whole.count() + whole.where("event_id < 100").count()
    assert {tuple(r) for r in stream.recent(spark, out, *columns, 3).collect()} == want
    stream.compacted(spark, out, str(tmp_path / "whole"), *columns)
    assert stream.last_visits(spark, str(tmp_path / "whole"), *columns).exceptAll(stream.last_visits(spark, out, *columns)).count() == 0
    q = stream.visits_by_window(events, "ts", "1 day", "1000 days").writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("w").agg(F.sum("n_visits")).first()[0] == whole.count() + whole.where("event_id < 100").count()
