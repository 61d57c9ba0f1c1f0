"""Visually identical text with different characters (problem 4).

Every distinct title gets a form (compatibility composed, fully case-folded,
white space mapped, ignorable characters removed, look-alike letters mapped).
Titles of equal form are candidates, found by an equi-join; as case, raised and
circled characters can be seen, candidates are then compared by their ``look``.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.looks import look, look_column, per_distinct
from lexmill.operators.orphans import prefixed
from lexmill.session import table


def fold(text: str, *table) -> str:
    """The comparison form: compatibility composed (NFKC), fully case-folded,
    white space mapped to one space, ignorable characters removed. Look-alikes
    are mapped before case is folded, so pairs that only look alike in one case
    still meet; texts with equal ``look`` always have equal ``fold``."""
    seen = look(text, *table)
    return unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", seen).casefold())


def fold_column(column: Column | str) -> Column:
    """``fold`` of a string column; null stays null, empty stays empty."""
    return per_distinct(fold, column)


def forms(*titles: DataFrame) -> DataFrame:
    """(title, form), one row per distinct non-null title of one-column frames.

    Empty text has empty forms; a text of ignorable characters only has them too.
    """
    every = reduce(DataFrame.union, titles).toDF("title").where("title is not null").distinct()
    return every.select("title", fold_column("title").alias("form"))


def same_look(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Pairs of rows that differ in title but look the same.

    left: src_table, src_id, title and the columns of ``on``; right: page_id,
    title and the columns of ``on``. Null titles are in no pair; repeated rows
    count once; copies of a title are looked at once, being joined by form.
    """
    left = left.where("title is not null").distinct()
    right = right.where("title is not null").distinct()
    known = forms(left.select("title"), right.select("title"))
    a = left.join(known, "title").withColumnRenamed("title", "src_title")
    b = right.join(known, "title").withColumnRenamed("title", "page_title")
    candidates = a.join(b, [*on, "form"]).where("src_title <> page_title")
    return candidates.where(look_column("src_title") == look_column("page_title"))


def sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Snapshot titles, local redirect titles with prefix, and page titles."""
    bundle = table(spark, sf_dir, "bundle_pages").select(F.lit("bundle_pages").alias("src_table"), F.col("revision_id").alias("src_id"), F.col("page_id").alias("key"), "title")
    local = table(spark, sf_dir, "redirects").where("title is not null and coalesce(interwiki, '') = ''").select("id", "ns", "title").distinct()
    redirects = prefixed(F.col("ns"), F.col("title"), table(spark, sf_dir, "namespace_registry"), local)
    redirects = redirects.select(F.lit("redirects").alias("src_table"), F.col("id").alias("src_id"), F.col("ns").cast("long").alias("key"), F.col("full_title").alias("title"))
    return bundle, redirects, table(spark, sf_dir, "pages").select("id", "ns", "title")


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src_table, src_id, page_id): snapshot titles against the title of their
    page, redirect titles against all page titles of their namespace."""
    bundle, redirects, pages = sources(spark, sf_dir)
    # one key space for both relations: the page id, or the namespace below all ids
    by_page = pages.select(F.lit("bundle_pages").alias("src_table"), F.col("id").alias("key"), F.col("id").alias("page_id"), "title")
    by_ns = pages.select(F.lit("redirects").alias("src_table"), F.col("ns").cast("long").alias("key"), F.col("id").alias("page_id"), "title")
    pairs = same_look(bundle.union(redirects), by_page.union(by_ns), ["src_table", "key"])
    return pairs.select("src_table", "src_id", "page_id").distinct()


def title_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    bundle, redirects, pages = sources(spark, sf_dir)
    return forms(bundle.select("title"), redirects.select("title"), pages.select("title")).withColumn("look", look_column("title"))
