"""Dimensions built from dumps and captures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def namespace_registry(capture: DataFrame, declared: DataFrame) -> DataFrame:
    """Captured namespaces joined with those a dump declares; one that only one side has is an error."""
    both = capture.join(declared.select("id", F.col("name").alias("declared")), "id", "full")
    fine = F.when(F.col("name").isNull() | F.col("declared").isNull(), F.raise_error(F.concat(F.lit("namespace on one side only: "), F.col("id").cast("string")))).otherwise(F.lit(True))
    return both.where(fine)


def redirect_rows(redirect: DataFrame) -> DataFrame:
    """The redirect table with hexadecimal text columns; a repeated page is an error."""
    n = redirect.groupBy("rd_from").agg(F.count("*").alias("_n"))
    once = redirect.join(n, "rd_from").where(F.when(F.col("_n") > 1, F.raise_error(F.lit("repeated redirect"))).otherwise(F.lit(True)))
    text = lambda c: F.lower(F.hex(F.encode(F.coalesce(c, F.lit("")), "UTF-8")))
    return once.select(F.col("rd_from").alias("page_id"), F.col("rd_namespace").alias("ns"), text("rd_title").alias("title_hex"), text("rd_interwiki").alias("interwiki_hex"), text("rd_fragment").alias("fragment_hex"))


def page_links(page: DataFrame, props: DataFrame) -> DataFrame:
    """(title, item) of pages with an entity."""
    items = props.where("pp_propname = 'wikibase_item'").select(F.col("pp_page").alias("page_id"), F.col("pp_value").alias("item"))
    return page.join(items, "page_id").select(F.translate("page_title", "_", " ").alias("title"), "item")


def language_registry(site: DataFrame, iso: DataFrame) -> DataFrame:
    """(kind, code, name): site names are canonical, names of the ISO table are aliases of known codes."""
    canonical = site.select(F.lit("canonical").alias("kind"), "code", "name")
    aliases = iso.join(site.select("code"), "code", "left_semi").select(F.lit("alias").alias("kind"), "code", "name").join(canonical.select("code", "name"), ["code", "name"], "left_anti").select("kind", "code", "name")
    codes = site.select(F.lit("code").alias("kind"), "code", F.col("code").alias("name"))
    return canonical.unionByName(aliases.distinct()).unionByName(codes)


def file_rows(observed: DataFrame) -> DataFrame:
    """file, state (present, missing, redirect), width, height, mime. observed: file, document (JSON)."""
    get = lambda path: F.get_json_object("document", path)
    state = F.when(get("$.missing").isNotNull(), "missing").when(get("$.redirect").isNotNull(), "redirect").otherwise("present")
    return observed.select("file", state.alias("state"), get("$.imageinfo[0].width").try_cast("int").alias("width"), get("$.imageinfo[0].height").try_cast("int").alias("height"), get("$.imageinfo[0].mime").alias("mime"))


def message_rows(captured: DataFrame) -> DataFrame:
    """language, message, state, text of captured messages (JSON with name and either content or missing)."""
    shape = "array<struct<name:string,content:string,missing:string>>"
    rows = captured.select("language", F.explode(F.from_json("document", shape)).alias("m"))
    return rows.select("language", F.col("m.name").alias("message"), F.when(F.col("m.content").isNull(), "M").otherwise("V").alias("state"), F.coalesce("m.content", F.lit("")).alias("text"))


def tabular_data(captured: DataFrame, languages: list[str]) -> DataFrame:
    """name, row, column, value of tabular JSON; localised cells by the first language that has one."""
    shape = "struct<schema:struct<fields:array<struct<name:string,type:string>>>,data:array<array<string>>>"
    rows = captured.select("name", F.from_json("document", shape).alias("d")).select("name", "d.schema.fields", F.posexplode("d.data").alias("row", "cells"))
    cells = rows.select("name", "row", F.posexplode(F.arrays_zip("fields", "cells")).alias("i", "c"))
    value = F.when(F.col("c.fields.type") == "localized", F.coalesce(*[F.get_json_object("c.cells", f"$.{code}") for code in languages])).otherwise(F.col("c.cells"))
    return cells.select("name", "row", F.col("c.fields.name").alias("column"), value.alias("value"))


def merged_captures(captures: list[DataFrame], key: str, inventory: DataFrame) -> DataFrame:
    """Captures put together; a repeated key, or a key missing from either side, is an error."""
    whole = captures[0]
    for capture in captures[1:]:
        whole = whole.unionByName(capture)
    n = whole.groupBy(key).agg(F.count("*").alias("_n")).join(inventory.select(key).distinct().withColumn("_asked", F.lit(True)), key, "full")
    wrong = F.when(F.coalesce(F.col("_n"), F.lit(0)) != 1, F.lit("not captured once: ")).when(F.col("_asked").isNull(), F.lit("not asked for: "))
    fine = n.where(F.when(wrong.isNotNull(), F.raise_error(F.concat(wrong, F.col(key)))).otherwise(F.lit(True))).select(key)
    return whole.join(fine, key)
