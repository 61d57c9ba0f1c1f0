"""Page dumps in XML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()
PAGE = T.StructType(
    [
        T.StructField("title", _S),
        T.StructField("ns", T.IntegerType()),
        T.StructField("id", T.LongType()),
        T.StructField("redirect", T.StructType([T.StructField("_title", _S)])),
        T.StructField(
            "revision",
            T.StructType(
                [
                    T.StructField("id", T.LongType()),
                    T.StructField("timestamp", _S),
                    T.StructField("contributor", T.StructType([T.StructField("username", _S), T.StructField("ip", _S)])),
                    T.StructField("model", _S),
                    T.StructField("format", _S),
                    T.StructField("text", _S),
                ]
            ),
        ),
    ]
)
REQUIRED = ["title", "ns", "page_id", "revision_id", "revision_timestamp"]


def pages(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """One row per page of plain or bzip2 XML; the schema is fixed, nothing is inferred.

    strict: a cut-off page is an error. Else its row, and rows without a required
    field, have a reason in ``problem``.
    """
    schema = PAGE if strict else T.StructType([*PAGE.fields, T.StructField("_corrupt_record", _S)])
    raw = spark.read.format("xml").option("rowTag", "page").option("mode", "FAILFAST" if strict else "PERMISSIVE").schema(schema).load(path)
    r = F.col("revision")
    out = raw.select(
        "title",
        "ns",
        F.col("id").alias("page_id"),
        F.col("redirect._title").alias("redirect"),
        r["id"].alias("revision_id"),
        r["timestamp"].alias("revision_timestamp"),
        F.coalesce(r["contributor"]["username"], r["contributor"]["ip"], F.lit("")).alias("revision_user"),
        r["model"].alias("content_model"),
        r["format"].alias("content_format"),
        F.coalesce(r["text"], F.lit("")).alias("source"),
        *([] if strict else [F.col("_corrupt_record")]),
    )
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), c) for c in REQUIRED]))
    if strict:
        return out.where(F.when(F.size(missing) > 0, F.raise_error(F.concat(F.lit("page without "), F.array_join(missing, ", ")))).otherwise(F.lit(True)))
    return out.withColumn("problem", F.when(F.col("_corrupt_record").isNotNull(), "cut off").when(F.size(missing) > 0, F.concat(F.lit("without "), F.array_join(missing, ", ")))).drop("_corrupt_record")


def namespaces(spark: SparkSession, path: str) -> DataFrame:
    """(id, case_policy, name) of the siteinfo of a dump."""
    schema = T.StructType([T.StructField("_VALUE", _S), T.StructField("_key", T.IntegerType()), T.StructField("_case", _S)])
    raw = spark.read.format("xml").option("rowTag", "namespace").schema(schema).load(path)
    return raw.select(F.col("_key").alias("id"), F.col("_case").alias("case_policy"), F.coalesce("_VALUE", F.lit("")).alias("name"))
