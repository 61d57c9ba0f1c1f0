"""Writing: dictionaries, reports, inventories, and their publication."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.session import cut


def blob_name(heading):
    return F.concat(F.sha2(heading, 256), F.lit(".wikblb"))


def sorted_for_lookup(entries: DataFrame, partitions: int | None = None, buckets: int = 16) -> DataFrame:
    """Rows shuffled by kind, language and title hash bucket, sorted by title within each task.

    A large language is spread over buckets of titles, so no task gets all of it;
    ``buckets_of`` gives their number for a corpus.
    """
    keys = ["kind", "language", F.pmod(F.xxhash64("title"), F.lit(buckets))]
    spread = entries.repartition(partitions, *keys) if partitions else entries.repartition(*keys)
    return spread.sortWithinPartitions("kind", "language", "title")


#: Entries of one title bucket.
BUCKET_ROWS = 1_000_000


def buckets_of(entries: DataFrame, rows: int = BUCKET_ROWS) -> int:
    """Title buckets so that the largest language has about ``rows`` entries in each."""
    most = entries.groupBy("kind", "language").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    return max(1, -(-(most or 0) // rows))


def duplicate_titles(entries: DataFrame) -> DataFrame:
    return entries.groupBy("kind", "language", "title").agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def write_dictionary(entries: DataFrame, root: str) -> None:
    """entries (kind, language, title, ...) under root, one folder per kind and language.

    Repeated titles are an error, found before anything is written.
    """
    entries = cut(entries)  # read for the check, the size and the rows
    if not duplicate_titles(entries).isEmpty():
        raise ValueError("repeated titles")
    n = buckets_of(entries)
    sorted_for_lookup(entries.withColumn("title_lc", F.lower("title")), buckets=n).write.mode("overwrite").partitionBy("kind", "language").option("compression", "zstd").parquet(f"{root}/entries")


def manifest(entries: DataFrame) -> DataFrame:
    """heading, file, n_records of each language, in order."""
    return entries.where("kind = 'language'").groupBy(F.col("language").alias("heading")).agg(F.count("*").alias("n_records")).withColumn("file", blob_name(F.col("heading"))).orderBy("heading")


def fallback_report(reasons: DataFrame) -> DataFrame:
    """ns, title, reasons without repeats in first order; pages without a reason have no line."""
    return reasons.withColumn("reasons", F.array_distinct("reasons")).where(F.size("reasons") > 0).select("ns", "title", "reasons")


def write_json_lines(df: DataFrame, path: str, order: list[str]) -> None:
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").json(path)


def json_response(rows: DataFrame, query: str, fields: list[str]) -> DataFrame:
    """Each row as one JSON object with the query it answers."""
    return rows.select(F.to_json(F.struct(F.lit("results.v1").alias("schema"), F.lit(query).alias("query"), *fields)).alias("json"))


def inventory(spark: SparkSession, root: str, required: list[str] = []) -> DataFrame:  # noqa: B006
    """path, size, sha256 of all files under root, in order; a required file that is missing is an error."""
    base = _path(spark, root)
    base = base.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(base).toString().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    # file systems differ in the slashes behind the scheme
    bare = lambda x: F.regexp_replace(x, "^([a-z0-9]+:)/+", "$1/")
    rows = files.select(F.substring(bare(F.col("path")), F.char_length(bare(F.lit(base))) + 2, 1 << 30).alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))
    for name in required:
        if rows.where(F.col("path") == name).isEmpty():
            raise FileNotFoundError(name)
    return rows.orderBy("path")


def catalogue(files: DataFrame, base_url: str) -> DataFrame:
    """url, label, bytes, sha256 of an inventory."""
    return files.select(F.concat(F.lit(base_url.rstrip("/") + "/"), "path").alias("url"), F.regexp_extract("path", r"([^/]+)$", 1).alias("label"), F.col("size").alias("bytes"), "sha256")


def _path(spark: SparkSession, name: str):
    return spark._jvm.org.apache.hadoop.fs.Path(name)


def publish(spark: SparkSession, root: str, write, check) -> None:
    """Writes to a hidden folder beside root, checks it, and only then puts it in root's place.

    Through the file system of root, whichever it is: where a rename is no single
    step, as in object stores, the check still comes before anything is replaced.
    """
    target = _path(spark, root)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    target = fs.makeQualified(target)
    hidden = f".{target.getName()}-{uuid.uuid4().hex}"
    staging, old = (_path(spark, f"{target.getParent().toString()}/{hidden}{x}") for x in ("", "-old"))
    try:
        write(staging.toString())
        check(staging.toString())
        if fs.exists(target):
            fs.rename(target, old)
        if not fs.rename(staging, target):
            if fs.exists(old):
                fs.rename(old, target)
            raise OSError(f"{root} could not be put in place")
        fs.delete(old, True)
    finally:
        fs.delete(staging, True)
