"""Accessors of entity documents kept as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.strings import col
from lexmill.operators import nested


def canonical_id(x) -> Column:
    """The id in capitals without leading zeros (Q1, P2, L3, L3-F1, L3-S2); null if it is none."""
    bare = F.upper(F.trim(col(x)))
    tidy = F.regexp_replace(bare, r"(?<=[QPLFS])0+(?=[0-9])", "")
    return F.when(tidy.rlike("^(?:[QP][1-9][0-9]*|L[1-9][0-9]*(?:-[FS][1-9][0-9]*)?)$"), tidy)


def is_valid_id(x) -> Column:
    return F.coalesce(col(x).rlike("^(?:[QP][1-9][0-9]*|L[1-9][0-9]*(?:-[FS][1-9][0-9]*)?)$"), F.lit(False))


def entity_url(x, base: str) -> Column:
    return F.concat(F.lit(base), F.when(col(x).startswith("P"), "Property:").when(col(x).startswith("L"), "Lexeme:").otherwise(""), col(x))


def by_fallback(texts: Column, languages: list[str]) -> Column:
    """(language, value) of the first language of a chain that a JSON object of terms has."""
    found = F.array_compact(F.array(*[F.when(F.get_json_object(texts, f"$.{code}.value").isNotNull(), F.struct(F.lit(code).alias("language"), F.get_json_object(texts, f"$.{code}.value").alias("value"))) for code in languages]))
    return F.try_element_at(found, F.lit(1))


def lemma(captures: DataFrame, languages: list[str]) -> DataFrame:
    """(capture_id, lemma struct<language, value>): of every capture that has a lemma in any
    shape, the one of the first language of the chain, else of the least other language."""
    code = F.array_position(F.array(*map(F.lit, languages)), F.col("language"))
    rank = F.when(code == 0, len(languages) + 1).otherwise(code)
    best = F.min(F.struct(rank.alias("rank"), "language", "value"))
    return nested.lemmas_table(captures).groupBy("capture_id").agg(best.alias("b")).select("capture_id", F.struct("b.language", "b.value").alias("lemma"))


def statements(captures: DataFrame, best: bool = True) -> DataFrame:
    """Statements of the entities themselves; best: the preferred ones of a property, or the
    normal ones if none is preferred, never deprecated ones."""
    rows = nested.claims_table(captures).where("parent_path = ''").drop("parent_path").distinct()
    if not best:
        return rows
    rank = F.when(F.col("rank") == "preferred", 2).when(F.col("rank") == "normal", 1)
    w = Window.partitionBy("capture_id", "property")
    return rows.withColumn("_r", rank).withColumn("_best", F.max("_r").over(w)).where("_r = _best").drop("_r", "_best")


def property_values(captures: DataFrame, best: bool = True) -> DataFrame:
    """(capture_id, property, text): the plain values of a property joined by commas, in order."""
    main = F.from_json(F.col("body.mainsnak"), "struct<snaktype:string,datavalue:struct<type:string,value:string>>")
    value = main["datavalue"]["value"]
    text = F.coalesce(F.get_json_object(value, "$.text"), F.get_json_object(value, "$.id"), F.get_json_object(value, "$.amount"), F.get_json_object(value, "$.time"), value)
    rows = statements(captures, best).withColumn("v", F.when(main["snaktype"] == "value", text)).where("v is not null")
    return rows.groupBy("capture_id", "property").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("position", "v"))), lambda x: x["v"]), ", ").alias("text"))


def lexical_categories(entities: DataFrame) -> DataFrame:
    """(entity, lexical_category, language) of lexeme documents (entity, document); null where a document has none."""
    pick = lambda name: F.coalesce(F.get_json_object("document", f"$.{name}.id"), F.get_json_object("document", f"$.{name}"))
    return entities.select("entity", pick("lexicalCategory").alias("lexical_category"), pick("language").alias("language"))
