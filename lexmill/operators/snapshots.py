"""What changed between full snapshots (problem 6).

Integer keys are their own persistent ordinals. The states of 64 neighbouring
ordinals in one snapshot are a bitmap word and a state vector aligned with it;
AND-NOT of the words of consecutive snapshots gives additions and removals,
the vectors are compared where both words have the bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import bitmaps
from lexmill.session import table


def instant(text: str) -> Column:
    """A timestamp written in any of several ways; without an offset it is UTC, unreadable text is null."""
    return F.expr(rf"try_cast(case when {text} rlike '(Z|[+-][0-9]{{2}}:?[0-9]{{2}})$' and {text} rlike ':' then {text} else concat({text}, 'Z') end as timestamp)")


def snapshot_changes(rows: DataFrame, snapshot: str, key: str, state: list[Column]) -> DataFrame:
    """(snapshot, key, change_kind) for consecutive snapshots.

    The state of a key in a snapshot is its greatest (state...) tuple. A change
    is reported under the later snapshot; the first one gives none. Rows with a
    null snapshot or key are left out; null state columns are lowest and equal
    each other; repeated rows count once.
    """
    rows = rows.select(F.col(snapshot).alias("snap"), F.col(key).cast("bigint").alias("k"), F.struct(*[c.alias(f"s{i}") for i, c in enumerate(state)]).alias("st"))
    rows = rows.where("snap is not null and k is not null")
    # one value per delivery of the whole table: a handful, however long the table
    order = rows.select("snap").distinct().agg(F.sort_array(F.collect_list("snap")).alias("all")).scalar()
    states = rows.groupBy("snap", "k").agg(F.max("st").alias("st"))
    words = states.groupBy(bitmaps.word(F.col("k")).alias("word"), "snap").agg(
        F.bit_or(bitmaps.bit(F.col("k"))).alias("bits"),
        F.collect_list(F.struct(F.col("k").bitwiseAND(F.lit(63)).cast("int").alias("o"), "st")).alias("vec"),
    )
    # every word is the later side of its own step and the earlier side of the next
    later = F.array_position(order, F.col("snap")).cast("int")
    sides = words.select("word", "bits", "vec", F.explode(F.array(F.struct(later.alias("step"), F.lit(1).alias("new")), F.struct((later + 1).alias("step"), F.lit(0).alias("new")))).alias("x"))
    nil = F.lit(0).cast("bigint")

    def side(column: str, new: int) -> Column:
        return F.any_value(F.when(F.col("x.new") == new, F.col(column)), True)

    steps = sides.groupBy("word", F.col("x.step").alias("step")).agg(
        F.coalesce(side("bits", 0), nil).alias("b0"), F.coalesce(side("bits", 1), nil).alias("b1"), side("vec", 0).alias("v0"), side("vec", 1).alias("v1")
    )
    steps = steps.withColumn("all", order).where("step between 2 and size(all)")
    differs = F.filter(F.array_except("v1", "v0"), lambda x: F.call_function("getbit", F.col("b0"), x["o"]) == 1)

    def kind(at: Column, name: str) -> Column:
        return F.struct(F.lit(name).alias("kind"), at.alias("at"))

    cases = F.array(
        kind(bitmaps.offsets(bitmaps.minus(F.col("b1"), F.col("b0"))), "added"),
        kind(bitmaps.offsets(bitmaps.minus(F.col("b0"), F.col("b1"))), "removed"),
        kind(F.coalesce(F.transform(differs, lambda x: x["o"]), F.array().cast("array<int>")), "changed"),
    )
    return (
        steps.select("word", F.element_at("all", F.col("step")).alias("snap"), F.explode(cases).alias("c"))
        .select("word", "snap", "c.kind", F.explode("c.at").alias("o"))
        .select(F.col("snap").alias(snapshot), (F.col("word") * 64 + F.col("o")).alias(key), F.col("kind").alias("change_kind"))
    )


def bundle_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "bundle_pages").select("snapshot_id", "page_id", "revision_id", "revision_timestamp")
    return snapshot_changes(pages, "snapshot_id", "page_id", [F.col("revision_id"), instant("revision_timestamp")])
