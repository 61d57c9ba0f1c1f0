"""Tab-separated snapshots with fixed schemas. A row that does not fit is an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the snapshots by name.
SCHEMAS = {
    "page_index": "stream_id int, offset bigint, length bigint, title string, redirect string, page_id bigint, revision_id bigint, revision_timestamp string, revision_user string, content_model string, ns int, has_source boolean, needs_decode boolean",
    "page_index_raw": "offset bigint, length bigint, title string, redirect string, page_id bigint, revision_id bigint, revision_timestamp string, revision_user string, content_model string, ns int, has_source boolean, needs_decode boolean",
    "redirects": "page_id bigint, ns int, title_hex string, interwiki_hex string, fragment_hex string",
    "languages": "kind string, code string, name string",
    "category_stats": "category string, n_all bigint, n_subcats bigint, n_files bigint",
    "category_tree": "category string, scope string, members string",
    "messages": "language string, message string, state string, text string",
    "files": "file string, state string, width int, height int, mime string",
    "interwiki": "prefix string, url string, local boolean",
    "sitelinks": "entity string, site string, title string",
    "entities": "entity string, document string",
    "overrides": "source string, target string",
    "fallbacks": "code string, chain string",
    "commons_data": "name string, state string, content_model string, document string",
    "edges": "kind string, source string, target string",
    "counts": "kind string, target string, n bigint",
    "catalogue": "url string, label string, bytes bigint, sha256 string",
}
#: Columns that tell rows apart.
KEYS = {"redirects": ["page_id"], "category_stats": ["category"], "category_tree": ["category", "scope"], "messages": ["language", "message"], "files": ["file"], "interwiki": ["prefix"], "sitelinks": ["entity", "site"], "entities": ["entity"], "overrides": ["source"], "fallbacks": ["code"], "commons_data": ["name"]}


def read(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A snapshot by its name; lines that begin with # are its header and are skipped."""
    reader = spark.read.schema(SCHEMAS[name]).option("sep", "\t").option("mode", "FAILFAST").option("comment", "#").option("quote", "").option("emptyValue", "").option("nullValue", "\\N")
    return reader.csv(path)


def header(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of the header lines ``# key: value``."""
    lines = spark.read.text(path).where(F.col("value").startswith("#"))
    return lines.select(F.regexp_extract("value", r"^#\s*([^:]+):", 1).alias("key"), F.trim(F.regexp_extract("value", r"^#[^:]+:(.*)$", 1)).alias("value"))


def row_count(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where(~F.col("value").startswith("#")).agg(F.count("*").alias("n_rows"))


def checked(df: DataFrame, name: str) -> DataFrame:
    """The rows, or an error when a key is on two of them; the check is part of the plan."""
    keys = KEYS.get(name)
    if not keys:
        return df
    n = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    joined = df.join(n, keys)
    return joined.where(F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"{name}: repeated key "), F.concat_ws("/", *keys)))).otherwise(F.lit(True))).drop("_n").select(*df.columns)


def redirects(spark: SparkSession, path: str) -> DataFrame:
    """page_id, ns, title, interwiki, fragment with the hexadecimal columns decoded."""
    raw = checked(read(spark, path, "redirects"), "redirects")
    return raw.select("page_id", "ns", *[F.decode(F.unhex(F.coalesce(f"{c}_hex", F.lit(""))), "UTF-8").alias(c) for c in ("title", "interwiki", "fragment")])


def registry(spark: SparkSession, path: str) -> DataFrame:
    """A namespace registry: ten fixed columns and any number of alias columns."""
    cells = spark.read.text(path).where(~F.col("value").startswith("#")).select(F.split("value", "\t", -1).alias("c"))
    names = [("id", "int"), ("name", "string"), ("canonical_name", "string"), ("case_policy", "string"), ("has_subpages", "boolean"), ("is_content", "boolean"), ("is_includable", "boolean"), ("content_model", "string"), ("ns_role", "string"), ("reason", "string")]
    fixed = [F.element_at("c", i).cast(kind).alias(name) for i, (name, kind) in enumerate(names, 1)]
    return cells.select(*fixed, F.filter(F.slice("c", 11, 10_000), lambda x: x != "").alias("aliases"))


def ambiguous_names(registry: DataFrame) -> DataFrame:
    """Names or aliases (lower case) of more than one namespace."""
    names = registry.select("id", F.explode(F.array_distinct(F.concat(F.array(F.lower("name"), F.lower("canonical_name")), F.transform("aliases", F.lower)))).alias("name"))
    return names.where("name <> ''").groupBy("name").agg(F.count_distinct("id").alias("n_ids")).where("n_ids > 1")


def tree_members(tree: DataFrame) -> DataFrame:
    """category, scope, position, member of a category tree whose members are separated by bars."""
    return tree.select("category", "scope", F.posexplode(F.filter(F.split("members", r"\|"), lambda x: x != "")).alias("position", "member"))


def unescaped(column: str):
    r"""Text of a column that writes tab, line feed, return and backslash as \t \n \r \\."""
    c = F.replace(F.col(column), F.lit("\\\\"), F.lit("\x00"))
    for mark, char in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r")):
        c = F.replace(c, F.lit(mark), F.lit(char))
    return F.replace(c, F.lit("\x00"), F.lit("\\"))


def escaped(column: str):
    c = F.replace(F.col(column), F.lit("\\"), F.lit("\\\\"))
    for mark, char in (("\\t", "\t"), ("\\n", "\n"), ("\\r", "\r")):
        c = F.replace(c, F.lit(char), F.lit(mark))
    return c


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """url, label, bytes, sha256 of lines with one to four columns, and what is wrong with them."""
    lines = spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").startswith("#"))
    c = F.split("value", "\t", -1)
    cells = lines.select(F.size(c).alias("n"), *[F.nullif(F.get(c, F.lit(i)), F.lit("")).alias(x) for i, x in enumerate(("url", "label", "size", "sha256"))])
    problem = F.when(F.col("n") > 4, "columns").when(~F.coalesce(F.col("url").startswith("https://"), F.lit(False)), "url").when(F.col("sha256").isNotNull() & ~F.col("sha256").rlike("^[0-9a-f]{64}$"), "sha256").when(F.col("size").isNotNull() & F.col("size").try_cast("bigint").isNull(), "bytes")
    return cells.select("url", "label", F.col("size").try_cast("bigint").alias("bytes"), "sha256", problem.alias("problem"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The headings of a language manifest, whose first line is ``heading``; blank lines are errors."""
    lines = spark.read.text(path, wholetext=True).select(F.split(F.regexp_replace("value", r"\r?\n$", ""), r"\r?\n").alias("l"))
    fine = F.when(F.col("l")[0] != "heading", F.raise_error(F.lit("no manifest"))).otherwise(F.slice("l", 2, 1_000_000))
    return lines.select(F.posexplode(fine).alias("position", "heading")).where(F.when(F.trim("heading") == "", F.raise_error(F.lit("blank heading"))).otherwise(F.lit(True)))


def category_stats(spark: SparkSession, path: str) -> DataFrame:
    """key, n_all, n_subcats, n_files; subcategories and files are part of all, and a key stands once."""
    rows = _table(spark, path, "key string, n_all long, n_subcats long, n_files long")
    bad = (F.col("n_subcats") + F.col("n_files") > F.col("n_all")) | (F.least("n_all", "n_subcats", "n_files") < 0)
    checked = rows.withColumn("n_all", F.when(bad, F.raise_error(F.concat(F.lit("counts of "), "key"))).otherwise(F.col("n_all")))
    return _unique(checked, "key")


def interwiki_map(spark: SparkSession, path: str) -> DataFrame:
    """prefix, url, is_local, is_current, is_transcludable; a prefix stands once, in lower case."""
    rows = _table(spark, path, "prefix string, url string, is_local boolean, is_current boolean, is_transcludable boolean")
    return _unique(rows.withColumn("prefix", F.lower("prefix")), "prefix")


def redirect_overrides(spark: SparkSession, path: str) -> DataFrame:
    """src, dst: templates that stand for others; a name stands for one."""
    return _unique(_table(spark, path, "src string, dst string"), "src")


def _table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=schema, comment="#", quote="", mode="FAILFAST")


def _unique(rows: DataFrame, key: str) -> DataFrame:
    """The rows, an error where a key stands on more than one; counted by partial aggregation."""
    columns = [c for c in rows.columns if c != key]
    one = rows.groupBy(key).agg(F.count("*").alias("_n"), F.first(F.struct(*columns)).alias("_row"))
    return one.select(F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("repeated "), key))).otherwise(F.col(key)).alias(key), "_row.*")


def usage_edges(edges: DataFrame) -> DataFrame:
    """value: the lines of edges (kind, source, target) with tabs, line ends and backslashes escaped."""
    safe = lambda c: F.replace(F.replace(F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit("\t"), F.lit("\\t")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    return edges.select(F.concat_ws("\t", *[safe(c) for c in ("kind", "source", "target")]).alias("value"))
