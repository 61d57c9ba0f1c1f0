"""Random reads of dumps, literal tables, profiles and small accounts."""

from __future__ import annotations

import bz2
import json

import pytest
from pyspark.sql import functions as F

from lexmill.operators import accounting as A
from lexmill.operators import entries, wikibase
from lexmill.sources import archives, luadata, siteinfo


def test_random_reads(spark, tmp_path):
    pages = [f"<page><title>T{i}</title><id>{i}</id><text>é {i}</text></page>" for i in range(40)]
    file, index = tmp_path / "dump.bz2", []
    with open(file, "wb") as out:
        for i in range(0, 40, 10):
            raw = bz2.compress("".join(pages[i : i + 10]).encode())
            index += [(j, str(file) if i else f"file://{file}", out.tell(), len(raw)) for j in range(i, i + 10)]
            out.write(raw)
    rows = spark.createDataFrame([*index, (99, str(file), index[0][2], index[0][3])], "page_id long, path string, offset long, length long")
    got = archives.windows(rows, ["page_id"]).select("page_id", archives.page_of(F.col("content"), F.col("page_id")).alias("xml")).collect()
    assert {r.page_id: r.xml for r in got} == dict(enumerate(pages)) | {99: None}
    with pytest.raises(Exception, match="behind the end"):
        archives.windows(rows.withColumn("length", F.lit(10**6)), ["page_id"]).collect()
    with pytest.raises(Exception, match="cut off"):
        archives.windows(rows.where("page_id = 0").withColumn("length", F.col("length") - 3), ["page_id"]).collect()


SOURCE = """-- data
local m = {} --[==[ long
comment ]==]
m["en"] = { "English", 1860, "gmw", otherNames = {"Modern English"}, ["x y"] = 0x10; }
m.de = { 'Ger\\tman', nil, aliases = { [[High German]], "D\\195\\164utsch" }, t = true, f = -1.5e2 }
return m"""


def test_literal_tables(spark):
    got = luadata.literal_tables(SOURCE)
    assert got["en"] == {1: "English", 2: 1860, 3: "gmw", "otherNames": {1: "Modern English"}, "x y": 16}
    assert got["de"] == {1: "Ger\tman", 2: None, "aliases": {1: "High German", 2: "Däutsch"}, "t": True, "f": -150.0}
    for bad in ("return f(1)", "m = 1 + 2", "m.a = function() end", 'm["a"] = b', "return {", "for i = 1, 2 do end", "return {" * 300):
        assert luadata._json(bad) is None
    df = spark.createDataFrame([(SOURCE,), ("return f()",), (None,)], "source string")
    rows = {tuple(r) for r in luadata.language_rows(df).collect()}
    assert rows == {("canonical", "en", "English"), ("alias", "en", "Modern English"), ("code", "en", "en"), ("canonical", "de", "Ger\tman"), ("alias", "de", "High German"), ("alias", "de", "Däutsch"), ("code", "de", "de")}


def test_profiles(spark, tmp_path):
    words = spark.createDataFrame([("int", True, "INT:"), ("int", True, "INT:"), ("if", False, "#wenn")], "id string, case_sensitive boolean, alias string")
    assert {tuple(r) for r in siteinfo.with_profile(words, "p", ["int", "lst"]).collect()} == {("p", "int", True, "INT:"), ("p", "lst", False, "lst")}
    names = lambda *rows: spark.createDataFrame(list(rows), "code string, name string")
    assert {tuple(r) for r in siteinfo.display_names({"en": names(("de", "German"))}, names(("de", "Deutsch"))).collect()} == {("en", "de", "German"), (None, "de", "Deutsch")}
    with pytest.raises(Exception, match="several names of de"):
        siteinfo.display_names({"en": names(("de", "German"), ("de", "Teutonic"))}).collect()
    (tmp_path / "d.json").write_text(json.dumps({"language": "ru", "digits": "0123456789", "timezone": "UTC", "months": {"name": ["январь"], "genitive": ["января"]}}))
    assert {tuple(r) for r in siteinfo.date_numbering(spark, str(tmp_path / "d.json")).collect()} == {("ru", "0123456789", "UTC", "name", 1, "январь"), ("ru", "0123456789", "UTC", "genitive", 1, "января")}
    manifest = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "wiki string, file string")
    assert siteinfo.selected_files(manifest, ["a"]).count() == 2 and siteinfo.selected_files(manifest).count() == 3
    with pytest.raises(Exception, match="no files of c"):
        siteinfo.selected_files(manifest, ["a", "c"]).collect()


def test_small_reports(spark):
    record = A.page_coverage_record(spark.range(10), 4, 20, "x").first()
    assert tuple(record) == (4, 20, 6, 10, "x") and A.page_coverage_record(spark.range(10), 40, None, "x").first().seen == 0
    docs = spark.createDataFrame([("L1", '{"lexicalCategory":{"id":"Q1"},"language":"Q2"}'), ("L2", "{}"), ("L3", None)], "entity string, document string")
    assert {tuple(r) for r in wikibase.lexical_categories(docs).collect()} == {("L1", "Q1", "Q2"), ("L2", None, None), ("L3", None, None)}
    page = spark.createDataFrame([(1, "t", "en", "{|\n! h !! 漢字\n|-\n| abc\n|}")], "id long, title string, language string, source string")
    table = entries.compiled(page, ["id"]).select(entries.table_text(F.col("entry.sections")[0]["blocks"][0]["table"])).first()[0]
    assert table == "| h   | 漢字 |\n|-----|------|\n| abc |      |"
