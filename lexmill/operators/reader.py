"""Lookup, prefix search, paging and aliases over a table of entries.

Entries: kind, language, title and payload columns. ``prepared`` stores the
lower-cased title, so a case-insensitive prefix is a range on a stored column
that Parquet statistics can skip by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_LIMIT, MAX_WINDOW = 1000, 131_072


def prepared(entries: DataFrame) -> DataFrame:
    return entries.withColumn("title_lc", F.lower("title"))


def _after(prefix: str) -> str | None:
    """The least text above all that begin with prefix (by code point), null for none."""
    for i in range(len(prefix) - 1, -1, -1):
        if ord(prefix[i]) < 0x10FFFF:
            up = ord(prefix[i]) + 1
            return prefix[:i] + chr(0xE000 if 0xD800 <= up <= 0xDFFF else up)
    return None


def _range(column: str, prefix: str) -> Column:
    high = _after(prefix)
    low = F.col(column) >= prefix
    return low & (F.col(column) < high) if high else low


def exact(entries: DataFrame, title: str) -> DataFrame:
    """Rows of exactly this title, byte for byte."""
    return entries.where(F.col("title") == title)


def folded(entries: DataFrame, query: str) -> DataFrame:
    """The exact title if there is one, else the first title that is equal when lower-cased."""
    low = F.lower(F.lit(query))
    return entries.where(F.col("title_lc") == low).orderBy((F.col("title") == query).desc(), "title").limit(1)


def folded_many(entries: DataFrame, queries: DataFrame) -> DataFrame:
    """``folded`` for each row of queries (query); queries without a match keep a null title."""
    wanted = queries.select("query").distinct().withColumn("title_lc", F.lower("query"))
    best = wanted.join(entries.select("title", "title_lc"), "title_lc").groupBy("query").agg(F.min(F.struct((F.col("title") != F.col("query")).alias("inexact"), "title")).alias("b"))
    return wanted.select("query").join(best, "query", "left").select("query", F.col("b.title").alias("title"), (~F.col("b.inexact")).alias("exact"))


def prefix(entries: DataFrame, text: str, column: str = "title") -> DataFrame:
    """Rows whose title begins with text; an empty text takes all."""
    return entries.where(_range(column, text)) if text else entries


def page(rows: DataFrame, order: list[str], limit: int, offset: int = 0) -> DataFrame:
    """One page of rows in an order, with total and has_more.

    The limit is 1..1000, and no more than 131,072 matches can be paged through.
    """
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError("the limit must be 1..1000")
    if offset < 0 or offset + limit > MAX_WINDOW:
        raise ValueError(f"a search window ends at {MAX_WINDOW}")
    total = rows.agg(F.count("*")).scalar()
    # sorting with an offset and a limit keeps offset + limit rows per task
    shown = rows.orderBy(*order).offset(offset).limit(limit)
    return shown.withColumn("total", total).withColumn("has_more", F.lit(offset + limit) < F.col("total"))


def search(entries: DataFrame, query: str, limit: int = 20, offset: int = 0) -> DataFrame:
    """Case-insensitive prefix search, ordered by the lower-cased title, then the title."""
    low = query.strip().lower()
    hits = entries.where(_range("title_lc", low)) if low else entries
    return page(hits, ["title_lc", "title"], limit, offset)


def aliases_resolved(aliases: DataFrame, definitions: DataFrame) -> DataFrame:
    """One hop from each alias (kind, title, target) to a definition (kind, title).

    A target that is an alias itself is shown, not followed; else the definition
    of the same kind counts, else that of the least other kind; without any the
    alias stays unfollowed.
    """
    again = aliases.select(F.col("title").alias("target"), F.col("kind").alias("k2"), F.lit(True).alias("is_alias")).distinct()
    found = definitions.select(F.col("title").alias("target"), F.col("kind").alias("def_kind")).distinct()
    best = aliases.join(found, "target", "left").groupBy("kind", "title", "target").agg(F.min(F.struct((F.col("def_kind") != F.col("kind")).alias("other"), "def_kind")).alias("b"))
    out = best.join(again.where("is_alias").withColumnRenamed("k2", "kind"), ["kind", "target"], "left")
    kind = F.when(F.col("is_alias"), "alias").when(F.col("b.def_kind") == F.col("kind"), "same kind").when(F.col("b.def_kind").isNotNull(), "other kind").otherwise("unfollowed")
    return out.select("kind", "title", "target", kind.alias("resolution"), F.when(F.col("is_alias").isNull(), F.col("b.def_kind")).alias("target_kind"))


def overlay_conflicts(aliases: DataFrame, definitions: DataFrame) -> DataFrame:
    """Titles that occur twice in the union of aliases and definitions: (kind, title, n_rows)."""
    both = aliases.select("kind", "title").unionByName(definitions.select("kind", "title"))
    return both.groupBy("kind", "title").agg(F.count("*").alias("n_rows")).where("n_rows > 1")


class Dictionary:
    """A dictionary stored as Parquet under a folder: entries by kind and language, and aliases."""

    def __init__(self, spark: SparkSession, root: str, language: str | None = None, kind: str = "language"):
        self.spark, self.root, self.language, self.kind = spark, root, language, kind

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> Dictionary:
        return cls(spark, root)

    def select(self, language: str | None = None, kind: str = "language") -> Dictionary:
        return Dictionary(self.spark, self.root, language, kind)

    def entries(self) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.root}/entries").where(F.col("kind") == self.kind)
        return rows.where(F.col("language") == self.language) if self.language else rows

    def lookup(self, title: str) -> DataFrame:
        return exact(self.entries(), title)

    def find(self, query: str) -> DataFrame:
        return folded(self.entries(), query)

    def search(self, text: str, limit: int = 20, offset: int = 0) -> DataFrame:
        return page(prefix(self.entries(), text), ["title"], limit, offset)

    def search_folded(self, text: str, limit: int = 20, offset: int = 0) -> DataFrame:
        return search(self.entries(), text, limit, offset)

    def languages(self) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.root}/entries").where("kind = 'language'")
        return rows.groupBy("language").agg(F.count("*").alias("n_records")).orderBy("language")

    def stats(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/entries").groupBy("kind").agg(F.count("*").alias("n_records"), F.count_distinct("language").alias("n_languages"))

    def random(self, seed: int) -> DataFrame:
        """A record chosen by a hash of the seed and the title."""
        return self.entries().orderBy(F.xxhash64(F.lit(seed), "title"), "title").limit(1)
