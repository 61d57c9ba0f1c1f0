"""Incremental forms of the reader's history and of coverage counters.

An extension: the batch operators are the reference; over a finished stream
these give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lexmill.operators.sequences import recency


def visits_by_window(events: DataFrame, at: str, width: str, late: str = "1 hour", by: str | None = None) -> DataFrame:
    """Visits per window of event time; windows older than the watermark are closed and forgotten."""
    keys = [F.window(at, width).alias("window"), *([by] if by else [])]
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).groupBy(*keys).agg(F.count("*").alias("n_visits"))


def _merged(visits: DataFrame, owner: str, item: str, at: str) -> DataFrame:
    return visits.groupBy(owner, item).agg(F.max(at).alias(at), F.sum("n_visits").alias("n_visits"))


def keep_recent(events: DataFrame, path: str, owner: str, item: str, at: str) -> StreamingQuery:
    """Writes what each micro-batch adds under path: last visit and visits of the owners and items in it.

    The stream keeps no state, however many owners there are; a batch that is
    repeated after a failure overwrites its own folder. ``recent`` reads the lists.
    """

    def write(batch: DataFrame, number: int) -> None:
        seen = batch.select(owner, item, F.col(at).cast("timestamp").alias(at), F.lit(1).cast("long").alias("n_visits"))
        _merged(seen, owner, item, at).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return events.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).start()


def last_visits(spark: SparkSession, path: str, owner: str, item: str, at: str) -> DataFrame:
    """owner, item, last visit and visits so far, merged from what the batches wrote."""
    return _merged(spark.read.parquet(path), owner, item, at)


def recent(spark: SparkSession, path: str, owner: str, item: str, at: str, limit: int) -> DataFrame:
    """The recency lists as of the last batch."""
    return recency(last_visits(spark, path, owner, item, at), owner, item, [at], limit)


def compacted(spark: SparkSession, path: str, into: str, owner: str, item: str, at: str) -> None:
    """Writes the batches so far as one under another folder, for streams that run long."""
    last_visits(spark, path, owner, item, at).write.mode("overwrite").parquet(f"{into}/batch=0")
