"""Deeply nested semi-structured records to related flat tables (problem 5).

Nested higher-order expressions attach the keys and positions of all ancestors,
flatten joins the arrays, and one inline per target table emits the rows. All
of it runs in the JVM; a record is never collected with another one. Every
value is read as text first, so a level may be a list, one object in place of
a list, an empty list in place of an object, or text encoded once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.lazy import let
from lexmill.session import table


def _starts(text: Column, mark: str) -> Column:
    return F.ltrim(text).startswith(mark)


def _whole(text: Column) -> Column:
    """The text where it is exactly one complete JSON value, else null."""
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    alone = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", strict)
    return F.when(F.size(alone) == 1, text)


def unwrapped(text: Column) -> Column:
    """Complete JSON text without outer string encoding, however often it was encoded, else null.

    Every layer but the first escapes the quotes of the one in it, so a text has
    at most as many as its length has binary digits.
    """

    def layers(x: Column) -> Column:
        rounds = F.sequence(F.lit(1), F.ceil(F.log2(F.char_length(x))).cast("int") + 1)
        return F.aggregate(rounds, x, lambda inner, _: F.when(_starts(inner, '"'), let(_inner(inner), _whole)).otherwise(inner))

    return let(_whole(text), lambda x: F.when(_starts(x, '"'), layers(x)).otherwise(x))


def _inner(text: Column) -> Column:
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")[0]


def items(text: Column) -> Column:
    """The elements of a list as text; an object counts as a list of one, anything else as empty."""
    none = F.array().cast("array<string>")
    return F.coalesce(F.when(_starts(text, "["), F.from_json(text, "array<string>")).when(_starts(text, "{"), F.array(text)), none)


def entries(text: Column) -> Column:
    """(key, value as text) of an object; anything else has none."""
    none = F.array().cast("array<struct<key:string,value:string>>")
    return F.coalesce(F.when(_starts(text, "{"), F.map_entries(F.from_json(text, "map<string,string>"))), none)


def _path(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _statements(claims: Column, owner: Column) -> Column:
    """The statements of one claims object, each with its path and its owner's path."""

    def one(key: Column):
        return lambda text, i: F.struct(
            owner.alias("parent_path"),
            _path(F.when(owner == "", F.lit("")).otherwise(F.concat(owner, F.lit("/"))), "claims/", key, "/", i + 1).alias("node_path"),
            key.alias("property"),
            (i + 1).alias("position"),
            F.from_json(text, "struct<id:string,rank:string,type:string,mainsnak:string,qualifiers:string,references:string>").alias("body"),
        )

    return F.flatten(F.transform(entries(claims), lambda kv: F.transform(items(kv["value"]), one(kv["key"]))))


def _parts(text: Column, name: str) -> Column:
    """Forms or senses: (node_path, position, body)."""
    return F.transform(items(text), lambda x, n: F.struct(_path(name + "/", n + 1).alias("node_path"), (n + 1).alias("position"), x.alias("text")))


def claims_table(captures: DataFrame) -> DataFrame:
    """One row per statement: capture_id, node_path, parent_path, property, position, claim_id, rank, type, body.

    parent_path is empty for claims of the entity itself, else the path of its
    form or sense. Columns that are null or no complete JSON give no rows.
    """
    held = lambda part: F.from_json(part["text"], "struct<claims:string>")["claims"]
    # a projection of its own, so each column is read once however often it is used
    captures = captures.select("capture_id", *[unwrapped(F.col(c)).alias(c) for c in ("claims", "forms", "senses")])
    claims, forms, senses = (F.col(c) for c in ("claims", "forms", "senses"))
    every = F.concat(
        _statements(claims, F.lit("")),
        F.flatten(F.transform(_parts(forms, "forms"), lambda p: _statements(held(p), p["node_path"]))),
        F.flatten(F.transform(_parts(senses, "senses"), lambda p: _statements(held(p), p["node_path"]))),
    )
    return captures.select("capture_id", F.inline(every)).select("capture_id", "node_path", "parent_path", "property", "position", F.col("body.id").alias("claim_id"), "body.rank", "body.type", "body")


def snaks_table(captures: DataFrame) -> DataFrame:
    """One row per snak: capture_id, node_path, parent_path (its statement), role, property, position, snaktype, datatype, datavalue.

    A snak that is null or no object gives no row, but keeps its place in the count.
    """

    def snak(path: Column, role: str, prop: Column, at: Column, text: Column) -> Column:
        return F.struct(path.alias("path"), F.lit(role).alias("role"), prop.alias("prop"), at.cast("int").alias("at"), text.alias("text"))

    node, body = F.col("node_path"), F.col("body")

    def group(text: Column, role: str, base: Column) -> Column:
        return F.flatten(F.transform(entries(text), lambda kv: F.transform(items(kv["value"]), lambda x, k: snak(_path(base, "/", kv["key"], "/", k + 1), role, kv["key"], k + 1, x))))

    every = F.concat(
        F.array(snak(_path(node, "/mainsnak"), "mainsnak", F.col("property"), F.lit(1), body["mainsnak"])),
        group(body["qualifiers"], "qualifier", _path(node, "/qualifiers")),
        F.flatten(F.transform(items(body["references"]), lambda r, j: group(F.from_json(r, "struct<snaks:string>")["snaks"], "reference", _path(node, "/references/", j + 1)))),
    )
    shape = F.from_json("text", "struct<snaktype:string,datatype:string,datavalue:string>")
    return (
        claims_table(captures)
        .select("capture_id", node.alias("parent_path"), F.inline(every))
        .where(F.coalesce(_starts(F.col("text"), "{"), F.lit(False)))
        .withColumn("s", shape)
        .select("capture_id", F.col("path").alias("node_path"), "parent_path", "role", F.col("prop").alias("property"), F.col("at").alias("position"), "s.snaktype", "s.datatype", "s.datavalue")
    )


def lemmas_table(captures: DataFrame) -> DataFrame:
    """One row per lemma: capture_id, node_path, language, value.

    An object maps languages to lemmas; in a list each lemma names its own
    language. A lemma is an object with a value or plain text; null gives no row.
    """
    captures, text = captures.select("capture_id", unwrapped(F.col("lemmas")).alias("lemmas")), F.col("lemmas")
    shape = "struct<language:string,value:string>"
    mapped = F.transform(entries(text), lambda kv: F.struct(kv["key"].alias("language"), F.when(_starts(kv["value"], "{"), F.from_json(kv["value"], shape)["value"]).otherwise(kv["value"]).alias("value")))
    listed = F.transform(items(text), lambda x: F.from_json(x, shape))
    every = F.when(_starts(text, "["), listed).otherwise(mapped)
    found = captures.select("capture_id", F.inline(every)).where("value is not null and language is not null")
    return found.select("capture_id", F.concat(F.lit("lemmas/"), "language").alias("node_path"), "language", "value")


def parts_table(captures: DataFrame) -> DataFrame:
    """One row per form or sense: capture_id, node_path, kind, position, part_id, features, texts.

    texts holds the representations or glosses as (language, value).
    """
    read = "struct<id:string,representations:string,glosses:string,grammaticalFeatures:string>"

    def one(kind: str):
        return lambda p: F.struct(F.lit(kind).alias("kind"), p["node_path"].alias("node_path"), p["position"].alias("position"), F.from_json(p["text"], read).alias("b"))

    captures = captures.select("capture_id", *[unwrapped(F.col(c)).alias(c) for c in ("forms", "senses")])
    every = F.concat(*[F.transform(_parts(F.col(c), c), one(c)) for c in ("forms", "senses")])
    texts = F.transform(entries(F.coalesce("b.representations", "b.glosses")), lambda kv: F.struct(kv["key"].alias("language"), F.from_json(kv["value"], "struct<value:string>")["value"].alias("value")))
    return captures.select("capture_id", F.inline(every)).where("b is not null").select("capture_id", "node_path", "kind", "position", F.col("b.id").alias("part_id"), items(F.col("b.grammaticalFeatures")).alias("features"), texts.alias("texts"))


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "wikibase").select("capture_id", "lemmas", "claims", "forms", "senses")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = captures(spark, sf_dir)
    return lemmas_table(rows).select("capture_id", "node_path").union(snaks_table(rows).select("capture_id", "node_path")).distinct()
