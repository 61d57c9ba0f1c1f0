"""References to records that do not exist (problem 2).

Keys are integers (string keys get ordinals of a dictionary). References are
turned into bitmaps per relation, period and key word, parents into bitmaps of
known, live and visible keys; reference AND-NOT parent leaves the orphans,
whose bits are decoded and joined back to the referring rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.looks import look_column
from lexmill.operators import bitmaps
from lexmill.session import cut, table

ALWAYS = "0001-01-01 00:00:00"


def _month(column: str):
    return (F.year(column) * 12 + F.month(column) - 1).cast("int")


def orphan_references(refs: DataFrame, parents: DataFrame) -> DataFrame:
    """(src_table, src_field, src_id, reason, period), distinct.

    refs: rel string, src_table, src_field, src_id, key bigint, touched_at.
    parents: rel string, key bigint, first_seen, deleted_at.

    Null keys are no references. A null touched_at has the period null and can
    be ``missing`` or ``deleted``, never ``late``. A live record without
    first_seen counts as always there. Repeated rows count once; without
    parents every reference is missing.
    """
    refs = refs.select("rel", "src_table", "src_field", "src_id", "key", "touched_at").where("key is not null").withColumn("month", F.coalesce(_month("touched_at"), F.lit(-1)))
    live = F.col("deleted_at").isNull()
    seen = F.coalesce(F.col("first_seen"), F.lit(ALWAYS).cast(dict(parents.dtypes)["first_seen"]))
    # read for the bitmaps and again for the instants of late keys
    keys = cut(parents.where("key is not null").groupBy("rel", "key").agg(F.min(F.when(live, seen)).alias("since")))
    words = (
        keys.groupBy("rel", bitmaps.word(F.col("key")).alias("word"), _month("since").alias("since_month"))
        .agg(F.bit_or(bitmaps.bit(F.col("key"))).alias("bits"))
        .groupBy("rel", "word")
        .agg(
            F.bit_or("bits").alias("known"),
            F.bit_or(F.when(F.col("since_month").isNotNull(), F.col("bits"))).alias("live"),
            # at most 64 entries: a key has one first month
            F.collect_list(F.when(F.col("since_month").isNotNull(), F.struct("since_month", "bits"))).alias("visible"),
        )
    )
    nil = F.lit(0).cast("bigint")
    before = F.aggregate(
        F.filter("visible", lambda x: x["since_month"] < F.col("month")),
        nil,
        lambda a, x: a.bitwiseOR(x["bits"]),
    )
    cases = (
        bitmaps.build(refs, "key", ["rel", "month"])
        .join(words, ["rel", "word"], "left")
        .select(
            "rel",
            "month",
            "word",
            F.explode(
                F.array(
                    F.struct(F.lit("missing").alias("case"), bitmaps.minus(F.col("bits"), F.col("known")).alias("left")),
                    F.struct(F.lit("deleted").alias("case"), bitmaps.minus(F.col("bits").bitwiseAND(F.coalesce("known", nil)), F.col("live")).alias("left")),
                    F.struct(F.lit("late").alias("case"), bitmaps.minus(F.col("bits").bitwiseAND(F.coalesce("live", nil)), before).alias("left")),
                )
            ).alias("x"),
        )
        .select("rel", "month", "word", F.col("x.case").alias("reason"), F.col("x.left").alias("left"))
        .where("left <> 0")
    )
    survivors = bitmaps.decode(cases, "left", "key")
    # "late" bits are candidates of the month in which the key came up: compare the instants
    late = survivors.where("reason = 'late'").join(keys, ["rel", "key"])
    survivors = survivors.where("reason <> 'late'").withColumn("since", F.lit(None).cast(dict(keys.dtypes)["since"])).unionByName(late)
    return (
        refs.join(survivors, ["rel", "key", "month"])
        .where("reason <> 'late' or touched_at < since")
        .select("src_table", "src_field", "src_id", "reason", F.date_format("touched_at", "yyyy-MM").alias("period"))
        .distinct()
    )


def prefixed(ns, title, registry: DataFrame, df: DataFrame) -> DataFrame:
    """df with full_title: underscores as spaces, the name of its namespace before it.

    The registry has one row per namespace of the wiki, a few dozen at most,
    so it is broadcast.
    """
    names = registry.select(F.col("id").alias("_ns"), F.col("name").alias("_name")).dropDuplicates(["_ns"])
    plain = F.translate(title, "_", " ")
    full = F.when(F.coalesce(F.col("_name"), F.lit("")) == "", plain).otherwise(F.concat("_name", F.lit(":"), plain))
    return df.join(F.broadcast(names), ns == F.col("_ns"), "left").withColumn("full_title", full).drop("_ns", "_name")


def relations(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The references and parents of links.target, redirects.id and redirects.title."""
    links, redirects = table(spark, sf_dir, "links"), table(spark, sf_dir, "redirects")
    pages, targets = table(spark, sf_dir, "pages"), table(spark, sf_dir, "targets")
    local = redirects.where("title is not null and coalesce(interwiki, '') = ''").select("id", "ns", "title", "touched_at")
    titled = prefixed(F.col("ns"), F.col("title"), table(spark, sf_dir, "namespace_registry"), local).select("id", "ns", F.col("full_title").alias("title"), "touched_at")
    dated = pages.where("title is not null").select("ns", "title", "first_seen", "deleted_at")
    # each title is looked at once, then everything joins its ordinal
    looks = cut(titled.select("ns", "title").union(dated.select("ns", "title")).distinct().withColumn("look", look_column("title")))
    ordinals = looks.join(bitmaps.dictionary(looks.select("ns", "look")), ["ns", "look"]).select("ns", "title", "ordinal")
    by_title = titled.join(ordinals, ["ns", "title"])
    page_keys = dated.join(ordinals, ["ns", "title"])

    def refs(df: DataFrame, name: str, field: str, src: str, key: str) -> DataFrame:
        return df.select(F.lit(f"{name}.{field}").alias("rel"), F.lit(name).alias("src_table"), F.lit(field).alias("src_field"), F.col(src).alias("src_id"), F.col(key).cast("bigint").alias("key"), "touched_at")

    def parents(df: DataFrame, rel: str, key: str) -> DataFrame:
        return df.select(F.lit(rel).alias("rel"), F.col(key).cast("bigint").alias("key"), "first_seen", "deleted_at")

    all_refs = refs(links, "links", "target", "link_id", "target").union(refs(redirects, "redirects", "id", "id", "id")).union(refs(by_title, "redirects", "title", "id", "ordinal"))
    all_parents = parents(targets, "links.target", "id").union(parents(pages, "redirects.id", "id")).union(parents(page_keys, "redirects.title", "ordinal"))
    return all_refs, all_parents


def orphans_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of orphan references by table, field, reason and month."""
    found = orphan_references(*relations(spark, sf_dir))
    return found.groupBy("src_table", "src_field", "reason", "period").agg(F.count("*").alias("n_refs"))
