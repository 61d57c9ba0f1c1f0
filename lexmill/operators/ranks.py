"""Global positions without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import cut


def with_position(df: DataFrame, order: list[Column | str], name: str = "position") -> DataFrame:
    """Adds the 1-based place of each row in the whole order.

    Rows are range-sorted and numbered within their partition; the sizes of the
    partitions before are added by a join with one row per partition. Rows that
    are equal in ``order`` are placed in an unspecified order among each other.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    part = F.shiftright(F.col("_id"), 33)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    ranged = cut(ranged.withColumn("_part", part).withColumn("_in", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id"))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition, so this window is small
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return ranged.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_in") + 1).drop("_part", "_in", "_before")


def with_running(df: DataFrame, order: list[Column | str], value: str, name: str = "running") -> DataFrame:
    """``with_position``, and the sum of value up to and with each row in that order.

    Sums run within the range partitions; what the partitions before hold is added
    by a join with one row per partition, so no task sees the whole order.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    ranged = cut(ranged.withColumn("_part", F.shiftright(F.col("_id"), 33)).withColumn("_in", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id"))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"), F.sum(value).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition, so this window and the broadcast are small
    offsets = sizes.select("_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before{c}") for c in ("_n", "_sum")])
    within = Window.partitionBy("_part").orderBy("_in").rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.withColumn("_summed", F.sum(value).over(within)).join(F.broadcast(offsets), "_part")
    return out.withColumn("position", F.col("_before_n") + F.col("_in") + 1).withColumn(name, F.col("_before_sum") + F.coalesce("_summed", F.lit(0))).drop("_part", "_in", "_summed", "_before_n", "_before_sum")


def first_per_group(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; a group larger than a block is cut down in
    blocks before its rows meet in one task."""
    salted = Window.partitionBy(*group, F.pmod(F.xxhash64(*df.columns), F.lit(64))).orderBy(*order)
    whole = Window.partitionBy(*group).orderBy(*order)
    near = df.withColumn("_rn", F.row_number().over(salted)).where(F.col("_rn") <= k).drop("_rn")
    return near.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)


def shards(df: DataFrame, order: list[Column | str], start: int, limit: int | None, size: int) -> DataFrame:
    """Rows start+1 .. start+limit of the order, with the number of their shard of ``size`` rows."""
    placed = with_position(df, order)
    kept = placed.where(F.col("position") > start) if limit is None else placed.where(F.col("position").between(start + 1, start + limit))
    return kept.withColumn("shard", F.floor((F.col("position") - start - 1) / size).cast("int"))
