"""Dimensions from site descriptions in JSON, and the choice of dumps."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_WORDS = "struct<query:struct<magicwords:array<struct<name:string,aliases:array<string>,`case-sensitive`:string>>>>"


def magic_words(spark: SparkSession, path: str) -> DataFrame:
    """id, case_sensitive, alias: one row per spelling of a magic word."""
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", _WORDS).alias("d"))
    word = raw.select(F.explode("d.query.magicwords").alias("w"))
    return word.select(F.col("w.name").alias("id"), F.col("w.`case-sensitive`").isNotNull().alias("case_sensitive"), F.explode("w.aliases").alias("alias"))


def behavior_switches(words: DataFrame) -> DataFrame:
    """The magic words written with two underscores at both ends."""
    return words.where(F.col("alias").rlike("^__.+__$|^＿＿.+＿＿$"))


def image_options(words: DataFrame) -> DataFrame:
    """The magic words of images (img_...), with whether they take a value ($1)."""
    return words.where(F.col("id").startswith("img_")).withColumn("takes_value", F.col("alias").contains("$1"))


def image_option(words: list[tuple[str, str]], text: str) -> tuple[str, str | None] | None:
    """(id, value) of the first alias in order that fits; a width must be positive and a value has no line feed."""
    for name, alias in words:
        m = re.fullmatch(re.escape(alias).replace(r"\$1", "([^\n]*)"), text)
        if m:
            value = m[1] if m.groups() else None
            if name == "img_width" and not re.fullmatch(r"(?:[1-9][0-9]*)?x?(?:[1-9][0-9]*)?", value or ""):
                continue
            return name, value
    return None


def language_names(spark: SparkSession, path: str, display: str) -> DataFrame:
    """display, code, name of the languages of a site description."""
    shape = "struct<query:struct<languages:array<struct<code:string,name:string>>>>"
    raw = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", shape)["query"]["languages"]).alias("l"))
    return raw.select(F.lit(display).alias("display"), "l.code", "l.name")


def site_statistics(spark: SparkSession, path: str) -> DataFrame:
    """One row with the seven counters of a site."""
    names = ["pages", "articles", "edits", "images", "users", "activeusers", "admins"]
    shape = f"struct<query:struct<statistics:struct<{','.join(f'{n}:bigint' for n in names)}>>>"
    return spark.read.text(path, wholetext=True).select(F.from_json("value", shape)["query"]["statistics"].alias("s")).select(*[f"s.{n}" for n in names])


def complete_dates(status: DataFrame, jobs: list[str]) -> DataFrame:
    """(wiki, date): the newest date on which all jobs asked for are done. status: wiki, date, job, done."""
    asked = status.where(F.col("job").isin(jobs))
    days = asked.groupBy("wiki", "date").agg(F.bool_and("done").alias("done"), F.count_distinct("job").alias("n"))
    return days.where((F.col("done")) & (F.col("n") == len(set(jobs)))).groupBy("wiki").agg(F.max("date").alias("date"))


def linktrail_ranges(pattern: str) -> list[tuple[int, int]]:
    """Code point ranges of a link trail pattern such as ``/^([a-zäöü]+)(.*)$/sD``."""
    m = re.search(r"\[((?:[^\]\\]|\\.)+)\]", pattern)
    if not m:
        return []
    body = re.sub(r"\\x\{([0-9a-fA-F]+)\}", lambda x: chr(int(x[1], 16)), m[1])
    out, i = [], 0
    while i < len(body):
        low = body[i]
        high = body[i + 2] if body[i + 1 : i + 2] == "-" and i + 2 < len(body) else low
        out.append((ord(low), ord(high)))
        i += 3 if high != low or body[i + 1 : i + 2] == "-" else 1
    merged: list[tuple[int, int]] = []
    for a, b in sorted(out):
        if merged and a <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(merged[-1][1], b))
        else:
            merged.append((a, b))
    return merged


def with_profile(words: DataFrame, profile: str, ids: list[str]) -> DataFrame:
    """The magic words of a profile (messages, languages, section inclusion ...): profile, id, case_sensitive, alias.

    A word without an alias of its own is known by its id.
    """
    own = words.where(F.col("id").isin(ids)).select(F.lit(profile).alias("profile"), "id", "case_sensitive", "alias").distinct()
    bare = words.sparkSession.createDataFrame([(profile, x, False, x) for x in ids], "profile string, id string, case_sensitive boolean, alias string")
    return own.unionByName(bare.join(own.select("id").distinct(), "id", "left_anti").select("profile", "id", "case_sensitive", "alias"))


def display_names(profiles: dict[str, DataFrame], autonyms: DataFrame | None = None) -> DataFrame:
    """display, code, name: the language names of several display languages as one dimension,
    those of the languages in themselves under a null display. A code stands once in each."""
    rows = None
    for display, names in sorted(profiles.items()):
        part = names.select(F.lit(display).alias("display"), "code", "name")
        rows = part if rows is None else rows.unionByName(part)
    if autonyms is not None:
        part = autonyms.select(F.lit(None).cast("string").alias("display"), "code", "name")
        rows = part if rows is None else rows.unionByName(part)
    one = rows.groupBy("display", "code").agg(F.count_distinct("name").alias("n"), F.min("name").alias("name"))
    return one.select("display", F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("several names of "), "code"))).otherwise(F.col("code")).alias("code"), "name")


def date_numbering(spark: SparkSession, path: str) -> DataFrame:
    """language, digits, timezone, form, month, name: how a language writes dates; form is name, genitive or short."""
    shape = "struct<language:string,digits:string,timezone:string,months:struct<name:array<string>,genitive:array<string>,short:array<string>>>"
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", shape).alias("d")).select("d.*")
    checked = raw.withColumn("digits", F.when(F.char_length("digits") != 10, F.raise_error(F.concat(F.lit("no ten digits of "), "language"))).otherwise(F.col("digits")))
    forms = F.array(*[F.struct(F.lit(f).alias("form"), F.col(f"months.{f}").alias("names")) for f in ("name", "genitive", "short")])
    rows = checked.select("language", "digits", "timezone", F.explode(forms).alias("f")).where("f.names is not null")
    return rows.select("language", "digits", "timezone", "f.form", F.posexplode("f.names").alias("month", "name")).withColumn("month", F.col("month") + 1)


def selected_files(manifest: DataFrame, wikis: list[str] | None = None) -> DataFrame:
    """The files of a manifest (wiki, ...) for the wikis asked for, all if none are; a wiki without files is an error."""
    if not wikis:
        return manifest
    wanted = manifest.sparkSession.createDataFrame([(w,) for w in sorted(set(wikis))], "wiki string")
    joined = wanted.join(manifest.withColumn("_have", F.lit(True)), "wiki", "left")
    found = joined.where(F.when(F.col("_have").isNull(), F.raise_error(F.concat(F.lit("no files of "), "wiki"))).otherwise(F.lit(True)))
    return found.select(*manifest.columns)
