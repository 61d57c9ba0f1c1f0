"""Reader, accounting, ordered rows, graphs, sources and sinks on small inputs."""

from __future__ import annotations

import bz2
import gzip
import random

import pytest
from pyspark.sql import functions as F

from lexmill.operators import accounting as A
from lexmill.operators import expansion, graphs, ranks, reader, wikibase
from lexmill.operators import sequences as Q
from lexmill.sources import archives, mysqldump, sinks, siteinfo, tsv, xml


def test_positions(spark):
    df = spark.createDataFrame([(x, "y") for x in random.Random(1).sample(range(1000), 300)], "x long, position2 string")
    got = ranks.with_position(df, ["x"]).orderBy("x").select("position").collect()
    assert [r[0] for r in got] == list(range(1, 301))
    assert ranks.with_position(df.where("false"), ["x"]).count() == 0
    top = ranks.first_per_group(spark.range(500).select((F.col("id") % 3).alias("g"), "id"), ["g"], [F.col("id").desc()], 2)
    assert {(r.g, r.id, r["rank"]) for r in top.collect()} == {(0, 498, 1), (0, 495, 2), (1, 499, 1), (1, 496, 2), (2, 497, 1), (2, 494, 2)}


def test_dictionary(spark, tmp_path):
    rows = [("language", lang, t, n) for n, (lang, t) in enumerate([("en", "cat"), ("en", "Cat"), ("en", "catfish"), ("en", "École"), ("ru", "МОСКВА"), ("el", "ΣΊΣΥΦΟΣ")])]
    entries = spark.createDataFrame(rows, "kind string, language string, title string, payload int")
    root = str(tmp_path / "dict")
    sinks.write_dictionary(entries, root)
    d = reader.Dictionary.open(spark, root)
    assert [r.payload for r in d.select("en").lookup("Cat").collect()] == [1]
    assert [r.title for r in d.select("en").find("CAT").collect()] == ["Cat"] and [r.title for r in d.find("σίσυφος").collect()] == ["ΣΊΣΥΦΟΣ"]
    first = d.select("en").search_folded("ca", 2).collect()
    assert [(r.title, r.total, r.has_more) for r in first] == [("Cat", 3, True), ("cat", 3, True)]
    assert [r.title for r in d.select("en").search("cat", 5, 1).collect()] == ["catfish"]
    assert [(r.language, r.n_records) for r in d.languages().collect()] == [("el", 1), ("en", 4), ("ru", 1)]
    assert d.stats().first().n_records == 6 and d.random(3).count() == 1
    plan = d.select("en").search_folded("ca", 2)._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "title_lc" in plan
    for limit, offset in ((0, 0), (1001, 0), (1000, 131_000)):
        with pytest.raises(ValueError):
            d.search("a", limit, offset)
    with pytest.raises(ValueError):
        sinks.write_dictionary(entries.union(entries), root)
    names = {r.heading: r.file for r in sinks.manifest(entries).collect()}
    assert set(names) == {"el", "en", "ru"} and all(len(f) == 64 + 7 for f in names.values())
    assert sinks.inventory(spark, root).count() > 0
    with pytest.raises(FileNotFoundError):
        sinks.inventory(spark, root, ["none"])


def test_aliases(spark, rows):
    aliases = spark.createDataFrame([("a", "x", "y"), ("a", "y", "z"), ("a", "q", "w"), ("a", "n", "nil"), ("a", "o", "only")], "kind string, title string, target string")
    definitions = spark.createDataFrame([("a", "z"), ("b", "w"), ("a", "w"), ("b", "only")], "kind string, title string")
    got = {r.title: (r.resolution, r.target_kind) for r in reader.aliases_resolved(aliases, definitions).collect()}
    assert got == {"x": ("alias", None), "y": ("same kind", "a"), "q": ("same kind", "a"), "n": ("unfollowed", None), "o": ("other kind", "b")}


def test_accounting(spark, rows):
    pages = spark.createDataFrame([(0, "main", True), (0, "main", None), (0, "compile_only", True), (None, "main", False)], "ns int, role string, has_source boolean")
    cover = A.input_coverage(pages)
    assert A.violations(cover, A.COVERAGE_RULES).count() == 0
    assert A.violations(cover.withColumn("input_rows", F.lit(9)), A.COVERAGE_RULES).count() == 2
    names = spark.createDataFrame([(0, 1, "a"), (0, 2, "b")], "ns int, n int, name string")
    assert A.merged([names, names.where("n = 1")], ["ns"], ["n"], ["name"]).first()[:] == (0, 4, None)
    report = spark.createDataFrame([(0, " ", ["x"]), (0, "a", []), (0, "b", ["x", "x"]), (0, "c", ["timeout"]), (0, "d", ["x"]), (0, "d", ["y"]), (0, "ok", ["x"])], "ns int, title string, reasons array<string>")
    assert {(r.title, r.problem) for r in A.fallback_problems(report).collect()} == {(" ", "blank title"), ("a", "no reason"), ("b", "repeated reason"), ("c", "operational failure"), ("d", "repeated page")}
    values = spark.createDataFrame([("a", 50), ("b", 30), ("c", 15), ("d", 5)], "k string, v long")
    assert [r.k for r in A.covering(values, "k", "v", 80, 100).orderBy("position").collect()] == ["a", "b"]
    assert [r.k for r in A.covering(values, "k", "v", 81, 100).orderBy("position").collect()] == ["a", "b", "c"]
    assert A.covering(values.where("false"), "k", "v", 1, 2).count() == 0
    left, right = spark.createDataFrame([("a",), ("b",), ("b",)], "t string"), spark.createDataFrame([("b",), ("c",)], "t string")
    assert rows(A.inventory_difference(left, right)) == [("a", "left"), ("b", "left"), ("c", "right")]
    drawn = A.reservoir(spark.range(100), "id", 10, 1)
    assert drawn.count() == 10 and drawn.first().population == 100


def test_ordered_rows(spark, rows):
    events = spark.createDataFrame([("u", "a", 1), ("u", "b", 2), ("u", "a", 3), ("u", "c", 4), ("v", "a", 1)], "u string, i string, t int")
    assert rows(Q.recency(events, "u", "i", ["t"], 2)) == [("u", "a", 2), ("u", "c", 1), ("v", "a", 1)]
    assert Q.recency(events, "u", "i", ["t"], 0).count() == 0
    assert {(r.u, r.i) for r in Q.toggles(events, "u", "i", ["t"]).collect()} == {("u", "b"), ("u", "c"), ("v", "a")}
    lists = spark.range(1).select(Q.merge_lists(*[F.array(*map(F.lit, x)) for x in (["a", "b", "c"], ["n", "a", "c"], ["m", "a", "b"])], 3).alias("m"))
    assert lists.first().m == ["n", "m", "a"]
    titles = spark.createDataFrame([("g", i, "x" * 9) for i in range(7)], "g string, o int, t string")
    assert [r.batch for r in Q.batches(titles, "g", ["o"], "t", 3, 1000).orderBy("o").collect()] == [0, 0, 0, 1, 1, 1, 2]
    assert max(r.batch for r in Q.batches(titles, "g", ["o"], "t", 100, 25).collect()) == 3
    files = spark.createDataFrame([("2020-01-01", 1, 5), ("2020-01-01", 2, 5), ("2020-01-02", 3, 5)], "d string, o int, s int").withColumn("d", F.col("d").cast("timestamp"))
    assert {r.o: r.keep for r in Q.evict_oldest(files, ["d", "o"], "s", 10).collect()} == {1: False, 2: True, 3: True}


def test_layout(spark):
    page = spark.createDataFrame([(1, "# a\n## b\n##: e\n# c\n#* q\n### d\n* x\n#: y"), (2, None), (3, "")], "id long, body string")
    got = {r.ord: (r.kind, r.parent, r.sense) for r in Q.sense_layout(Q.blocks(page.where("id = 1"), ["id"], "body"), ["id"]).collect()}
    assert got == {0: ("definition", None, None), 1: ("definition", 0, None), 2: ("example", None, 1), 3: ("definition", None, None), 4: ("quotation", None, 3), 5: ("definition", 3, None), 6: ("list_item", None, None), 7: ("example", None, 3)}
    text = spark.createDataFrame([(1, "lead\n==English==\n===Etymology 2===\n===Noun===\nx\n====Synonyms====\n===Verb===\n==?==\ny\n==French==\nz")], "id long, body string")
    names = spark.createDataFrame([("English", "en"), ("French", "fr")], "name string, code string")
    parts = Q.resolved_languages(Q.section_rows(text, ["id"], "body"), ["id"], names, "und")
    assert [r.language for r in parts.orderBy("ord").collect()] == ["en", "en", "en", "fr"]
    assert {r.language: r.first_ord for r in Q.language_groups(parts, ["id"]).collect()} == {"en": 0, "fr": 3}
    lex = Q.lexemes(Q.section_rows(text, ["id"], "body", (1, 2, 3, 4)).where("ord > 0"), ["id"])
    assert lex.count() >= 1
    heads = spark.createDataFrame([("Noun 2",), ("noun",), ("Nouns",), ("Noun ",), ("Etymology 1",), ("See also",), ("Etymology note",)], "h string").select(Q.part_of_speech(F.col("h")), Q.section_kind(F.col("h")))
    assert [tuple(r) for r in heads.collect()] == [("Noun", None), ("Noun", None), (None, None), ("Noun", None), (None, "etymology"), (None, "relations"), (None, None)]


def test_heading_rows(spark):
    text = "a\n== B ==\n<pre>\n== no ==\n</pre>\n<!-- x\n=== no ===\n-->\n=== C ===\r\n"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id long, source string")
    got = {(r.id, r.ord, r.level, r.heading) for r in Q.heading_rows(df, ["id"], "source").collect()}
    assert got == {(1, 0, 0, ""), (1, 1, 2, "B"), (1, 2, 3, "C"), (3, 0, 0, "")}


def test_batches_of_a_split_group(spark):
    rng = random.Random(4)
    rows = [(rng.choice([0, 0, 0, 10, None]), i, "x" * rng.randrange(1, 40)) for i in range(300)] + [(0, 999, None)]
    df = spark.createDataFrame(rows, "ns int, id long, title string")
    for shard in (1 << 16, 37):
        want, state = {}, {}
        for ns, i, title in sorted((r for r in rows if r[2]), key=lambda r: r[1]):
            n, batch, count, chars = state.get(ns, (0, -1, 0, 0))
            if n % shard == 0 or count >= 8 or chars + len(title) + 1 > 100:
                batch, count, chars = batch + 1, 0, 0
            state[ns] = (n + 1, batch, count + 1, chars + len(title) + 1)
            want[i] = batch
        got = Q.batches(df, "ns", ["id"], "title", 8, 100, shard).collect()
        assert {r.id: r.batch for r in got} == want and len(got) == len(want)


def test_running_sums(spark):
    df = spark.range(500).select((F.col("id") * 7 % 500).alias("k"), F.when(F.col("id") % 9 > 0, F.col("id")).alias("v"))
    run, want = 0, []
    for k, v in sorted((r.k, r.v) for r in df.collect()):
        run += v or 0
        want.append((k, run))
    assert [(r.k, r.running) for r in ranks.with_running(df, ["k"], "v").orderBy("position").collect()] == want
    assert ranks.with_running(df.where("false"), ["k"], "v").count() == 0


def test_accounting_of_runs(spark):
    rec = A.reconciled(spark.createDataFrame([(0, 5), (10, 2), (14, 3)], "ns int, expected long"), spark.createDataFrame([(0, 7), (10, 3), (4, 1)], "ns int, found long"), ["ns"], F.col("ns") == 0)
    assert {tuple(r) for r in rec.collect()} == {(10, 2, 3), (14, 3, 0), (4, 0, 1)}
    cover = spark.createDataFrame([(0, 10, 10, 100), (90, 20, 10, 100), (0, 10, 9, 100), (0, None, 101, 100), (101, 1, 0, 100)], "start long, limit long, seen long, total long")
    assert sorted((r.start, r.seen, r.problem) for r in A.page_coverage_problems(cover).collect()) == [(0, 9, "pages missing"), (0, 101, "pages too many"), (101, 0, "start behind the end")]
    a, b = spark.createDataFrame([("x",), ("y",)], "title string"), spark.createDataFrame([("y",), ("z",)], "title string")
    rows, problems = A.strict_union([a, b], "title", spark.createDataFrame([("x",), ("y",), ("w",)], "title string"))
    assert rows.count() == 4 and {tuple(r) for r in problems.collect()} == {("y", "repeated"), ("w", "not captured"), ("z", "not selected")}
    p = A.profile(spark.createDataFrame([(1, "m"), (1, "m"), (2, "m"), (2, "n")], "page long, node string"), spark.createDataFrame([("m", "k"), ("n", "k"), ("n", "k"), ("k", "k")], "src string, dst string"), spark.createDataFrame([("m", 5), ("n", 3)], "node string, value long"))
    assert {tuple(r) for r in p.collect()} == {("m", 5, 2, 0, 0), ("n", 3, 1, 0, 0), ("k", 0, 0, 8, 2)}
    work = A.work_statistics(spark.createDataFrame([("a", 1), ("a", None), ("b", 4)], "g string, n long"), ["g"], ["n"])
    assert {tuple(r) for r in work.collect()} == {("a", 2, 1, 1, 1), ("b", 1, 4, 4, 1)}


def test_graphs(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (5, 4), (6, 7), (1, 8), (4, 8), (9, 9), (None, 1)], "src long, dst long")
    n = spark.range(1, 11).withColumnRenamed("id", "node")
    assert {r.node: r.component for r in graphs.components(e, n).collect()} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8, 9: 9, 10: 10}
    assert {(r.node, r.hops) for r in graphs.reachable(e, spark.createDataFrame([(3,)], "node long")).collect()} == {(3, 0), (1, 1), (4, 1), (2, 2), (5, 2), (8, 2)}
    d = spark.createDataFrame([(1, 2), (1, 3), (2, 4), (3, 4), (4, 5)], "src long, dst long")
    assert {r.component: r.reach for r in graphs.reach(d, spark.createDataFrame([(1, 10), (3, 1)], "node long, value long")).collect()} == {1: 10, 2: 10, 3: 11, 4: 21, 5: 21}
    m = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x")], "src string, dst string")
    assert {(r.start, r.node, r.hops, r.loop) for r in graphs.follow(m, spark.createDataFrame([("a",), ("c",), ("x",)], "t string")).collect()} == {("a", "c", 2, False), ("c", "c", 0, False), ("x", None, None, True)}
    assert graphs.components(e.where("false"), n.where("false")).count() == 0


def test_expansion_both_ways(spark):
    pages = spark.createDataFrame([(1, "T", "{{a|x}} {{c}}"), (2, "U", None), (3, "V", "plain"), (4, "W", "{{#invoke:m|f}}")], "id long, title string, source string")
    templates = spark.createDataFrame([("a", "<{{{1}}}{{b}}>"), ("b", "B"), (None, "x")], "name string, source string")
    want = {1: "<xB> [[:Template:c]]", 2: None, 3: "plain", 4: "ok"}
    for limit in (1 << 20, 0):
        got = expansion.expanded(pages, templates, ["id"], modules={"m": {"f": lambda a, p: "ok"}}, broadcast_bytes=limit)
        assert {r.id: r.expanded for r in got.collect()} == want


def test_expansion_is_the_same_beyond_the_broadcast(spark):
    """Names known only at expansion and existence tests see all templates and titles in both plans."""
    pages = spark.createDataFrame(
        [(1, "{{#ifexist:Dog|yes|no}} {{#ifexist:Cow|yes|no}}"), (2, "{{ {{a}} }}"), (3, "{{x{{d|y}}}}"), (4, "{{ {{ {{one}} }} }}"), (None, "{{ {{none}} }}"), (5, "{{ {{a}} }}{{ {{a}} }}"), (5, "{{ {{a}} }}{{ {{a}} }}")], "id long, source string"
    ).withColumn("title", F.lit("T"))
    templates = spark.createDataFrame([("a", "b"), ("b", "BEE"), ("d", "{{{1}}}"), ("xy", "{{deep}}"), ("deep", "down"), ("one", "two"), ("two", "three"), ("three", "3"), ("none", "gone")], "name string, source string")
    titles = spark.createDataFrame([("Dog",), (None,)], "title string")
    want = [(None, "[[:Template:gone]]"), (1, "yes no"), (2, "BEE"), (3, "down"), (4, "3"), (5, "BEEBEE"), (5, "BEEBEE")]
    for limit in (1 << 25, 0):
        got = expansion.expanded(pages, templates, ["id"], broadcast_bytes=limit, titles=titles).collect()
        assert sorted(((r.id, r.expanded) for r in got), key=str) == sorted(want, key=str)
    for limit in (1 << 25, 0):
        got = expansion.expanded(pages, templates, ["id", "title"], broadcast_bytes=limit, titles=titles).collect()
        assert sorted(((r.id, r.expanded) for r in got), key=str) == sorted(want, key=str) and {r.title for r in got} == {"T"}
    bare = spark.createDataFrame([(1, "T", "{{#ifexist:b|yes|no}}")], "id long, title string, source string")
    assert [expansion.expanded(bare, templates, ["id"], broadcast_bytes=limit).first().expanded for limit in (1 << 25, 0)] == ["yes", "yes"]


def test_wikibase(spark):
    ids = spark.createDataFrame([(" q042",), ("L3-f01",), ("Q0",), ("x",), (None,)], "i string").select(wikibase.canonical_id("i"), wikibase.is_valid_id("i"))
    assert [tuple(r) for r in ids.collect()] == [("Q42", False), ("L3-F1", False), (None, False), (None, False), (None, False)]


PAGE_XML = """<mediawiki><siteinfo><namespaces><namespace key="0" case="first-letter" /><namespace key="10" case="first-letter">Template</namespace></namespaces></siteinfo>
<page><title>A &amp; B</title><ns>0</ns><id>1</id><redirect title="C" /><revision><id>9</id><timestamp>2020-01-01T00:00:00Z</timestamp><contributor><ip>1.2.3.4</ip></contributor><model>wikitext</model><format>text/x-wiki</format><text>x &lt;b&gt;</text></revision></page>
<page><title>D</title><ns>10</ns><id>2</id><revision><id>10</id><timestamp>2020-01-01T00:00:00Z</timestamp><contributor><username>u</username></contributor><text /></revision></page></mediawiki>"""


def test_xml(spark, tmp_path):
    (tmp_path / "p.xml").write_text(PAGE_XML)
    (tmp_path / "p2.xml.bz2").write_bytes(bz2.compress(PAGE_XML.encode()))
    for name in ("p.xml", "p2.xml.bz2"):
        got = {r.page_id: r for r in xml.pages(spark, str(tmp_path / name)).collect()}
        assert (got[1].title, got[1].redirect, got[1].revision_user, got[1].source) == ("A & B", "C", "1.2.3.4", "x <b>") and (got[2].redirect, got[2].source) == (None, "")
    assert {(r.id, r.name) for r in xml.namespaces(spark, str(tmp_path / "p.xml")).collect()} == {(0, ""), (10, "Template")}
    (tmp_path / "bad.xml").write_text(PAGE_XML.replace("<ns>10</ns>", ""))
    with pytest.raises(Exception, match="without ns"):
        xml.pages(spark, str(tmp_path / "bad.xml")).collect()
    assert sorted(r.problem or "" for r in xml.pages(spark, str(tmp_path / "bad.xml"), strict=False).collect()) == ["", "without ns"]


def test_mysqldump(spark, tmp_path):
    dump = "CREATE TABLE `page` (\n  `page_id` int NOT NULL,\n  `page_title` varbinary(255) NOT NULL,\n  `x` double,\n  PRIMARY KEY (`page_id`)\n) ENGINE=InnoDB;\nINSERT INTO `page` VALUES (1,'It\\'s \\\\ a','1'),(2,'b''c',NULL),(3,'),(',2.5);\nINSERT INTO `page` VALUES (4,'é',-1e3);\n"
    with gzip.open(tmp_path / "page.sql.gz", "wt", encoding="utf-8") as f:
        f.write(dump)
    got = mysqldump.read(spark, str(tmp_path / "page.sql.gz"), "page", "page_title string, page_id bigint").collect()
    assert [tuple(r) for r in got] == [("It's \\ a", 1), ("b'c", 2), ("),(", 3), ("é", 4)]
    for bad in ("(1,'a') x", "(1)", "(1,a)"):
        with pytest.raises(ValueError):
            list(mysqldump.tuples(bad, 2))


def test_archives(spark, tmp_path):
    parts = [b"one", b"two" * 1000, b""]
    (tmp_path / "m.bz2").write_bytes(b"".join(map(bz2.compress, parts)))
    got = archives.members(spark, str(tmp_path / "m.bz2")).orderBy("stream_id").collect()
    assert [bytes(r.content) for r in got] == parts and got[1].offset == got[0].length
    with pytest.raises(ValueError):
        list(archives.bzip2_members(bz2.compress(b"x" * 100)[:-5], 1000))
    import zstandard

    raw = zstandard.ZstdCompressor().compress(b"abc")
    assert archives.zstd_frame(raw, 3, 10) == b"abc"
    for args in ((raw, 4, 10), (raw, 3, 2), (b"nope", 3, 10)):
        with pytest.raises(ValueError):
            archives.zstd_frame(*args)


def test_tsv(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("# wiki: en\n1\t0\t" + "A b".encode().hex() + "\t\t\n2\t14\t" + "é".encode().hex() + "\t\t78\n")
    got = {r.page_id: (r.title, r.fragment) for r in tsv.redirects(spark, str(tmp_path / "r.tsv")).collect()}
    assert got == {1: ("A b", ""), 2: ("é", "x")}
    assert tsv.header(spark, str(tmp_path / "r.tsv")).first()[:] == ("wiki", "en") and tsv.row_count(spark, str(tmp_path / "r.tsv")).first().n_rows == 2
    (tmp_path / "dup.tsv").write_text("a\t1\t0\t0\na\t2\t0\t0\n")
    with pytest.raises(Exception, match="repeated key"):
        tsv.checked(tsv.read(spark, str(tmp_path / "dup.tsv"), "category_stats"), "category_stats").collect()
    (tmp_path / "c.tsv").write_text("# x\n\nhttps://a/b\tB\t12\t" + "a" * 64 + "\nhttp://x\nhttps://y\t1\t2\t3\t4\n")
    assert [r.problem for r in tsv.catalogue(spark, str(tmp_path / "c.tsv")).orderBy("url").collect()] == ["url", None, "columns"]
    (tmp_path / "m.txt").write_text("heading\nEnglish\nFrench\n")
    assert [r.heading for r in tsv.manifest(spark, str(tmp_path / "m.txt")).collect()] == ["English", "French"]
    df = spark.createDataFrame([("a\tb\\n\nc",)], "x string")
    assert df.select(tsv.escaped("x").alias("x")).select(tsv.unescaped("x")).first()[0] == "a\tb\\n\nc"
    (tmp_path / "ns.tsv").write_text("# h\n10\tVorlage\tTemplate\tfirst-letter\ttrue\tfalse\ttrue\twikitext\ttemplate\t\tV\tT\n1\tTalk\tTalk\tfirst-letter\ttrue\tfalse\tfalse\t\tcompile_only\t\tv\n")
    names = tsv.registry(spark, str(tmp_path / "ns.tsv"))
    assert {r.id: r.aliases for r in names.collect()} == {10: ["V", "T"], 1: ["v"]} and [r.name for r in tsv.ambiguous_names(names).collect()] == ["v"]


def test_siteinfo(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"query":{"magicwords":[{"name":"notoc","aliases":["__NOTOC__"]},{"name":"img_width","aliases":["$1px"],"case-sensitive":""}],"statistics":{"pages":5}}}')
    words = siteinfo.magic_words(spark, str(tmp_path / "s.json"))
    assert {(r.id, r.case_sensitive, r.alias) for r in words.collect()} == {("notoc", False, "__NOTOC__"), ("img_width", True, "$1px")}
    assert siteinfo.behavior_switches(words).count() == siteinfo.image_options(words).count() == 1
    assert siteinfo.image_option([("img_width", "$1px")], "20px") == ("img_width", "20") and siteinfo.image_option([("img_width", "$1px")], "-3px") is None
    status = spark.createDataFrame([("w", "1", "a", True), ("w", "1", "b", True), ("w", "2", "a", True), ("w", "2", "b", False), ("w", "3", "a", True)], "wiki string, date string, job string, done boolean")
    assert siteinfo.complete_dates(status, ["a", "b"]).first()[:] == ("w", "1")
    assert siteinfo.linktrail_ranges("/^([a-zäö]+)(.*)$/sD") == [(97, 122), (228, 228), (246, 246)]


def test_publish(spark, tmp_path):
    root = tmp_path / "d"
    (root).mkdir()
    (root / "old").write_text("1")

    def write(path):
        import os

        path = path.removeprefix("file:")
        os.mkdir(path)
        open(path + "/new", "w").close()

    def refuse(_):
        raise ValueError("bad")

    with pytest.raises(ValueError):
        sinks.publish(spark, str(root), write, refuse)
    assert [p.name for p in root.iterdir()] == ["old"]
    sinks.publish(spark, str(root), write, lambda p: None)
    assert [p.name for p in root.iterdir()] == ["new"] and [p.name for p in tmp_path.iterdir()] == ["d"]
