"""Filling fixed-capacity containers with items (problem 8).

Parts as large as the capacity fill a bin alone. The other items are spread over
blocks by a hash, each block is packed by best fit: bins are ordered by their
residual, each carries the sources and the clusters of equal texts it holds as
bitmaps, and the successor search goes up from the item's size to the tightest
bin without a copy of the item. Of equally tight bins one without the item's
source is taken first. Where every bin with room holds a copy, a new bin is
opened, as long as the room that would then be left over, beyond what the
remaining items need, stays within SLACK of the block. An item that cannot be
kept apart within that joins a bin that holds a copy and is marked as a clash:
a cluster of more copies than there are bins needs that. The rule is applied to
each item by itself; all others stay apart.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.tokens import counted
from lexmill.session import cut, table

#: Items below the capacity in one block; each block leaves at most about one bin part-filled.
BLOCK_ITEMS = 50_000
#: Share of a block's space that may stay unused to keep copies apart.
SLACK = 0.01


def _low(bits: int) -> int:
    return (bits & -bits).bit_length() - 1


def best_fit(sizes, sources, clusters, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, clash) of each item; items come largest first, none larger than capacity.

    A cluster below 0 is none. ``at[r]`` is the bitmap of the bins with residual
    r, ``open_`` the bitmap of the residuals in use, ``holding[c]`` and
    ``from_[s]`` the bitmaps of the bins that hold cluster c or source s. Items
    of equal size and cluster resume the search where the last one ended: lower
    residuals were all taken.
    """
    at: dict[int, int] = {}
    holding: dict[int, int] = {}
    from_: dict[object, int] = {}
    open_, n_bins, last, resume = 0, 0, None, 0
    to_come = int(sum(sizes))
    spare = int(to_come * SLACK) + capacity
    room = 0
    out, clash = np.empty(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=bool)
    for i, (size, source, cluster) in enumerate(zip(sizes, sources, clusters, strict=True)):
        held = holding.get(cluster, 0) if cluster >= 0 else 0
        start = resume if last == (size, cluster) else size
        left, chosen = open_ >> start << start, None
        while left:
            residual = _low(left)
            free = at[residual] & ~held
            if free:
                chosen = _low(free & ~from_.get(source, 0) or free)
                break
            left &= left - 1
        last, resume = (size, cluster), residual if chosen is not None else capacity + 1
        if chosen is None and open_ >> size and room + capacity - to_come > spare:
            # a new bin would stay empty beyond what is allowed for
            residual = size + _low(open_ >> size)
            chosen = _low(at[residual] & ~from_.get(source, 0) or at[residual])
            clash[i] = True
        if chosen is None:
            chosen, residual, n_bins = n_bins, capacity, n_bins + 1
            room += capacity
        else:
            at[residual] &= ~(1 << chosen)
            if not at[residual]:
                open_ &= ~(1 << residual)
        mark, rest = 1 << chosen, residual - size
        room, to_come = room - size, to_come - size
        at[rest] = at.get(rest, 0) | mark
        open_ |= 1 << rest
        if cluster >= 0:
            holding[cluster] = held | mark
        from_[source] = from_.get(source, 0) | mark
        out[i] = chosen
    return out, clash


def packed(sizes: DataFrame, budgets: list[tuple[str, int]]) -> DataFrame:
    """budget_name, bin_id, doc_id, part_no, token_start, n_tokens, clash: one row for each item.

    sizes: doc_id bigint, source, cluster bigint, n_tokens bigint.
    budgets: names and capacities, a short list of settings.

    An item larger than a capacity is split into full parts and a rest, all
    others stay whole. An item of size 0 (null or empty text) takes no room and
    is no copy of another. A null source is one of its own, an item of a null
    cluster has no copies. Repeated rows are items of their own. Bins never mix
    blocks; their ids are unique, below 0 for those one full part fills. clash
    marks the items that share a bin with a copy.
    """
    sizes = cut(sizes.select("doc_id", "source", "cluster", "n_tokens"))
    blocks = max(1, -(-sizes.count() // BLOCK_ITEMS))
    choices = F.array(*[F.struct(F.lit(name).alias("budget_name"), F.lit(int(room)).cast("long").alias("capacity")) for name, room in budgets])
    room, zero = F.col("capacity"), F.lit(0).cast("long")
    every = sizes.withColumn("b", F.explode(choices)).select("doc_id", "source", "cluster", "n_tokens", "b.*")
    whole = every.where(F.col("n_tokens") >= room).select("budget_name", "capacity", "doc_id", F.explode(F.sequence(zero, F.floor(F.col("n_tokens") / room) - 1)).alias("part_no"))
    # sizes is a written table, so a task that runs again counts the same
    filled = whole.select("budget_name", (-1 - F.monotonically_increasing_id()).alias("bin_id"), "doc_id", F.col("part_no").cast("int").alias("part_no"), (F.col("part_no") * room).alias("token_start"), room.alias("n_tokens"), F.lit(False).alias("clash"))
    full = F.floor(F.col("n_tokens") / room)
    items = every.where((F.col("n_tokens") % room > 0) | (F.col("n_tokens") == 0)).select(
        "budget_name",
        "capacity",
        "doc_id",
        full.cast("int").alias("part_no"),
        (full * room).alias("token_start"),
        (F.col("n_tokens") % room).alias("n_tokens"),
        F.coalesce("source", F.lit("")).alias("source"),
        # clusters are hashes: their positive half is enough, -1 is none
        F.when(F.col("cluster").isNull() | (F.col("n_tokens") == 0), F.lit(-1).cast("long")).otherwise(F.shiftrightunsigned("cluster", 1)).alias("cluster"),
        F.pmod(F.xxhash64("budget_name", "doc_id"), F.lit(blocks)).alias("block"),
    )

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "cluster", "doc_id", "part_no"], ascending=[False, True, True, True], kind="stable")
        bins, pdf["clash"] = best_fit(pdf["n_tokens"].tolist(), pdf["source"].tolist(), pdf["cluster"].tolist(), int(pdf["capacity"].iat[0]))
        pdf["bin_id"] = (pdf["block"].to_numpy() << 32) + bins
        return pdf[["budget_name", "bin_id", "doc_id", "part_no", "token_start", "n_tokens", "clash"]]

    rest = items.groupBy("budget_name", "block").applyInPandas(pack, "budget_name string, bin_id bigint, doc_id bigint, part_no int, token_start bigint, n_tokens bigint, clash boolean")
    return rest.unionByName(filled)


def budgets_of(spark: SparkSession, sf_dir: str) -> list[tuple[str, int]]:
    """The settings table of capacities: three rows, whatever the corpus."""
    return [(r[0], r[1]) for r in table(spark, sf_dir, "token_budgets").select("budget_name", "capacity_tokens").distinct().orderBy("budget_name").toLocalIterator()]


def corpus_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text", F.xxhash64("text").alias("cluster"))
    return packed(counted(docs, ["doc_id", "source", "cluster"]), budgets_of(spark, sf_dir))


def bin_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well each capacity is used, and how many items share a bin with a copy."""
    caps = dict(budgets_of(spark, sf_dir))
    names = F.create_map(*[F.lit(x) for pair in caps.items() for x in pair])
    per = corpus_bins(spark, sf_dir).groupBy("budget_name").agg(F.count_distinct("bin_id").alias("n_bins"), F.sum("n_tokens").alias("n_tokens"), F.count_if("clash").alias("n_clashes"))
    return per.withColumn("fill", F.round(F.col("n_tokens") / (F.col("n_bins") * names[F.col("budget_name")]), 6))


def packing_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """budget_name, n_docs, n_overfull, n_split, n_gaps: documents packed, bins above their
    capacity, documents split though they would fit, and documents whose parts leave a gap."""
    caps = dict(budgets_of(spark, sf_dir))
    names = F.create_map(*[F.lit(x) for pair in caps.items() for x in pair])
    rows = cut(corpus_bins(spark, sf_dir))
    room = names[F.col("budget_name")]
    bins = rows.groupBy("budget_name", "bin_id").agg(F.sum("n_tokens").alias("n")).groupBy("budget_name").agg(F.count_if(F.col("n") > room).alias("n_overfull"))
    docs = rows.groupBy("budget_name", "doc_id").agg(F.count("*").alias("parts"), F.sum("n_tokens").alias("n"), F.max(F.col("token_start") + F.col("n_tokens")).alias("stop"))
    per = docs.groupBy("budget_name").agg(F.count("*").alias("n_docs"), F.count_if((F.col("parts") > 1) & (F.col("n") <= room)).alias("n_split"), F.count_if(F.col("n") != F.col("stop")).alias("n_gaps"))
    return per.join(bins, "budget_name").select("budget_name", "n_docs", "n_overfull", "n_split", "n_gaps")
