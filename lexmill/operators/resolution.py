"""Names to languages and namespaces, titles to entities, messages by fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import strings as S


def name_key(name):
    """The key names are compared by: one kind of space, lower case."""
    return F.lower(S.normalize_space(name))


def languages(names: DataFrame, registry: DataFrame, trusted_only: bool = False) -> DataFrame:
    """(name, code, heading): each name by the registry (code, kind, name, trusted).

    kind is canonical, alias or code, in this order of preference; then the least code counts.
    A name that is canonical for several codes is resolved by nothing weaker.
    """
    order = F.when(F.col("kind") == "canonical", 0).when(F.col("kind") == "alias", 1).otherwise(2)
    known = (registry.where("trusted") if trusted_only else registry).withColumn("_key", name_key(F.col("name"))).withColumn("_order", order)
    heading = registry.where("kind = 'canonical'").groupBy("code").agg(F.min("name").alias("heading"))
    best = known.groupBy("_key").agg(F.min(F.struct("_order", "code")).alias("b")).select("_key", F.col("b.code").alias("code"))
    asked = names.select("name").distinct().withColumn("_key", name_key(F.col("name")))
    return asked.join(best, "_key", "left").join(heading, "code", "left").select("name", "code", "heading")


def strong_languages(registry: DataFrame) -> DataFrame:
    """Canonical names of exactly one code."""
    keyed = registry.where("kind = 'canonical'").withColumn("_key", name_key(F.col("name")))
    return keyed.groupBy("_key").agg(F.count_distinct("code").alias("n"), F.min("code").alias("code")).where("n = 1").select(F.col("_key").alias("name"), "code")


def namespaces(titles: DataFrame, registry: DataFrame) -> DataFrame:
    """(title, ns, rest): the namespace a title's prefix names, by name, canonical name or alias; 0 for none."""
    names = registry.select(F.col("id").alias("ns"), F.explode(F.array_distinct(F.array(name_key(F.col("name")), name_key(F.col("canonical_name"))))).alias("_key")).where("_key <> ''").dropDuplicates(["_key"])
    has = F.col("title").contains(":")
    keyed = titles.select("title").distinct().withColumn("_key", F.when(has, name_key(F.substring_index("title", ":", 1))))
    out = keyed.join(F.broadcast(names), "_key", "left")
    rest = F.trim(F.substring(F.col("title"), F.instr(F.col("title"), ":") + 1, 2147483647))
    return out.select("title", F.coalesce("ns", F.lit(0)).alias("ns"), F.when(F.col("ns").isNotNull(), rest).otherwise(F.col("title")).alias("rest"))


def sitelinks(entities: DataFrame, links: DataFrame, site: str) -> DataFrame:
    """(entity, title): the page of a site for each entity, null for none."""
    own = links.where(F.col("site") == site).select("entity", "title")
    return entities.select("entity").distinct().join(own, "entity", "left")


def messages(asked: DataFrame, known: DataFrame, fallbacks: DataFrame) -> DataFrame:
    """(language, message, text, source): each message in its language or the nearest fallback.

    known: language, message, state (V text, M known missing), text. fallbacks: code, chain
    array<string>. A message without any row has the source null.
    """
    chain = asked.select("language", "message").distinct().join(fallbacks.select(F.col("code").alias("language"), "chain"), "language", "left")
    tries = chain.select("language", "message", F.posexplode(F.concat(F.array("language"), F.coalesce("chain", F.array().cast("array<string>")))).alias("rank", "source"))
    found = tries.join(known.where("state = 'V'").select(F.col("language").alias("source"), "message", "text"), ["source", "message"])
    best = found.groupBy("language", "message").agg(F.min(F.struct("rank", "source", "text")).alias("b"))
    return asked.select("language", "message").distinct().join(best, ["language", "message"], "left").select("language", "message", "b.text", "b.source")


def aligned_sections(raw: DataFrame, rendered: DataFrame, key: list[str]) -> DataFrame:
    """Raw and rendered sections side by side by their order, and whether a page has equally
    many of both (aligned); of a page that has not, sections without a partner stay too."""
    def placed(df: DataFrame, name: str) -> DataFrame:
        w = Window.partitionBy(*key)
        return df.withColumn("place", F.row_number().over(w.orderBy("ord"))).withColumn(f"_n_{name}", F.count("*").over(w)).select(*key, "place", F.col("heading").alias(f"{name}_heading"), f"_n_{name}")

    both = placed(raw, "raw").join(placed(rendered, "rendered"), [*key, "place"], "full_outer")
    w = Window.partitionBy(*key)
    same = F.coalesce(F.max("_n_raw").over(w) == F.max("_n_rendered").over(w), F.lit(False))
    return both.withColumn("aligned", same).drop("_n_raw", "_n_rendered")


def study_cards(titles: DataFrame, n_choices: int, seed: int, limit: int) -> DataFrame:
    """(title, choices): limit cards drawn by a digest, each with the next drawn titles as
    distractors, the answer at a place of a digest. The deck has limit titles at most."""
    digest = lambda salt: F.md5(F.concat(F.lit(f"{salt}:"), "title"))
    drawn = titles.select("title").distinct().orderBy(digest(seed), "title").limit(limit)
    deck = drawn.agg(F.transform(F.sort_array(F.collect_list(F.struct(digest(seed).alias("at"), "title"))), lambda x: x["title"]).alias("deck")).select("deck", F.posexplode("deck").alias("i", "title"))
    others = F.transform(F.sequence(F.lit(1), F.lit(n_choices - 1)), lambda k: F.element_at("deck", ((F.col("i") + k) % F.size("deck") + 1).cast("int")))
    at = F.ascii(digest(seed + 1)) % n_choices
    return deck.select("title", F.array_insert(others, at + 1, F.col("title")).alias("choices"))


def edition_order(wikis: DataFrame, pilots: list[str], main: str) -> DataFrame:
    """Wikis in the order they are built: pilots, the main one, the rest by name."""
    place = F.array_position(F.array(*map(F.lit, [*pilots, main])), F.col("wiki"))
    return wikis.select("wiki").distinct().withColumn("place", F.when(place > 0, place).otherwise(F.lit(len(pilots) + 2))).orderBy("place", "wiki")


# languages declared in pages

# The words that declare a language in the headings of two editions.
DECLARATIONS = {"ar": "اللغة", "az": "Dil"}
ARABIC_LANGUAGE = "لغة"
_LABEL = r"[^{}\[\]<>|=\r\n]+"


def declared_language(heading, edition: str) -> Column:
    """The language a heading declares by its edition's template, or in Arabic by a word; null for none."""
    text = F.btrim(S.col(heading), F.lit(" \t"))
    if edition not in DECLARATIONS:
        return F.lit(None).cast("string")
    label = F.regexp_extract(text, rf"^\{{\{{[ \t]*{DECLARATIONS[edition]}[ \t]*\|({_LABEL})\}}\}}$", 1)
    if edition == "ar":
        label = F.coalesce(F.nullif(F.regexp_extract(text, rf"^{ARABIC_LANGUAGE}[ \t]+({_LABEL})$", 1), F.lit("")), label)
    return F.nullif(F.btrim(label, F.lit(" \t")), F.lit(""))


def marker_language(line) -> Column:
    """The code of a line that is a standalone language marker, ``{{-xx-}}`` or ``{{=xx=}}``; null for none."""
    text = F.btrim(S.col(line), F.lit(" \t\r"))
    code = F.regexp_extract(text, r"^\{\{[ \t]*(?:-[ \t]*([A-Za-z][A-Za-z0-9-]*?)[ \t]*-|=[ \t]*([A-Za-z][A-Za-z0-9-]*?)[ \t]*=)[ \t]*\}\}$", 1)
    other = F.regexp_extract(text, r"^\{\{[ \t]*=[ \t]*([A-Za-z][A-Za-z0-9-]*?)[ \t]*=[ \t]*\}\}$", 1)
    found = F.when(code != "", code).otherwise(other)
    return F.when(F.char_length(text) >= 7, F.nullif(found, F.lit("")))


def boundary_languages(headings: DataFrame, key: list[str], registry: DataFrame) -> DataFrame:
    """(key, heading, code): the language a heading names, by its text without quotes, or else by
    the links in it: target and label of a link, and all links, must agree, else it is null."""
    text = F.btrim(F.trim("heading"), F.lit("'\""))
    links = F.regexp_extract_all("heading", F.lit(r"\[\[:?([^\[\]{}<>]+)\]\]"), 1)
    names = F.flatten(F.transform(links, lambda x: F.filter(F.transform(F.split(x, r"\|", 2), lambda y: F.btrim(y, F.lit(" :\t"))), lambda y: y != "")))
    asked = headings.select(*key, "heading", F.posexplode(F.concat(F.array(text), names)).alias("place", "name"))
    known = languages(asked.select("name"), registry).select("name", "code")
    own = F.max(F.when(F.col("place") == 0, F.col("code")))
    linked = F.when(F.min("code") == F.max("code"), F.min("code"))
    found = asked.join(known, "name", "left").groupBy(*key, "heading").agg(F.coalesce(own, linked).alias("code"))
    return headings.select(*key, "heading").distinct().join(found, [*key, "heading"], "left")


def unsectioned_languages(categories: DataFrame, key: list[str], registry: DataFrame) -> DataFrame:
    """(key, code): the language of pages without language headings, if all their categories
    (key, name) that name a language, by a strong or a trusted name, name the same; else null."""
    strong = strong_languages(registry).select("name", "code")
    trusted = registry.where("trusted").select(name_key(F.col("name")).alias("name"), F.col("code").alias("other")).groupBy("name").agg(F.min("other").alias("other"))
    named = categories.select(*key, name_key(F.col("name")).alias("name")).join(strong, "name", "left").join(trusted, "name", "left")
    code = F.coalesce("code", "other")
    return named.groupBy(*key).agg(F.when(F.min(code) == F.max(code), F.min(code)).alias("code"))


# pages and entities


def entities_of(titles: DataFrame, links: DataFrame) -> DataFrame:
    """(title, entity): the entity of each page title by page links (title, entity); null for none, of several the least."""
    known = links.where("title is not null").groupBy("title").agg(F.min("entity").alias("entity"))
    return titles.select("title").distinct().join(known, "title", "left")


def contents(titles: DataFrame, pages: DataFrame) -> DataFrame:
    """(title, page_id, exists, is_redirect, length, content): what is known of each title from
    pages (title, page_id, redirect, source); of several pages of a title the newest id counts."""
    newest = F.max(F.struct("page_id", F.col("redirect").isNotNull().alias("is_redirect"), F.octet_length("source").alias("length"), F.col("source").alias("content")))
    known = pages.where("title is not null").groupBy("title").agg(newest.alias("p"))
    joined = titles.select("title").distinct().join(known, "title", "left")
    return joined.select("title", "p.page_id", F.col("p").isNotNull().alias("exists"), F.coalesce("p.is_redirect", F.lit(False)).alias("is_redirect"), "p.length", "p.content")


def redirects_bound(dump: DataFrame, table: DataFrame) -> DataFrame:
    """(page_id, xml_target, target, problem): each redirect of the dump (page_id, xml_target) with its row of
    the redirect table (page_id, target), compared byte for byte; problem is ``absent``, ``different`` or null."""
    both = dump.select("page_id", "xml_target").distinct().join(table.select("page_id", "target").distinct(), "page_id", "left")
    same = F.encode("xml_target", "UTF-8") == F.encode("target", "UTF-8")
    return both.withColumn("problem", F.when(F.col("target").isNull(), "absent").when(~F.coalesce(same, F.lit(False)), "different"))
