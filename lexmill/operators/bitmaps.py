"""Compressed bitmaps over integer keys, as rows of their non-zero 64-bit words.

A bitmap is a set of rows (word, bits): bit b of word w stands for key
w * 64 + b. Words without a bit have no row, so a sparse key range costs
nothing, and AND-NOT, OR and counting are joins and aggregates of Catalyst.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.session import cut


def word(key: Column) -> Column:
    return F.shiftright(key, 6)


def bit(key: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), key.bitwiseAND(F.lit(63)).cast("int"))


def minus(left: Column, right: Column) -> Column:
    """AND-NOT of two words; a missing right word has no bits."""
    return left.bitwiseAND(F.bitwise_not(F.coalesce(right, F.lit(0).cast("bigint"))))


def offsets(bits: Column) -> Column:
    """The positions 0..63 of the set bits."""
    return F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("getbit", bits, i) == 1)


def build(df: DataFrame, key: str, by: list[str]) -> DataFrame:
    """One row (by..., word, bits) for each non-zero word of each bitmap."""
    return df.where(F.col(key).isNotNull()).groupBy(*by, word(F.col(key)).alias("word")).agg(F.bit_or(bit(F.col(key))).alias("bits"))


def decode(df: DataFrame, bits: str, key: str) -> DataFrame:
    """A row for each set bit, with its key."""
    out = df.withColumn("_at", F.explode(offsets(F.col(bits))))
    return out.withColumn(key, F.col("word") * 64 + F.col("_at")).drop("_at", "word", bits)


def dictionary(values: DataFrame, into: str = "ordinal") -> DataFrame:
    """Persistent integer ordinals for the distinct rows of ``values``.

    The rows are range-sorted, so near values get near ordinals and share
    bitmap words; ordinals are dense within a partition. The result is written
    to the shared folder, so every reader sees the same ordinals.
    """
    columns = values.columns
    ranged = values.distinct().repartitionByRange(*columns).sortWithinPartitions(*columns)
    return cut(ranged.withColumn(into, F.monotonically_increasing_id()))
