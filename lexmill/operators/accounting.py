"""Counters, coverage, validation and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.operators.ranks import with_running

COUNTERS = ["input_rows", "compile_only_rows", "source_unavailable_rows", "dispatched_rows", "expanded_pages", "fallback_pages", "duplicate_rows", "alias_pages"]


def input_coverage(pages: DataFrame) -> DataFrame:
    """Per namespace: rows in, of a role that is only compiled, without source, and dispatched.

    pages: ns, role, has_source.
    """
    only, source = F.col("role") == "compile_only", F.coalesce("has_source", F.lit(False))
    return pages.groupBy("ns").agg(
        F.count("*").alias("input_rows"),
        F.count_if(only).alias("compile_only_rows"),
        F.count_if(~only & ~source).alias("source_unavailable_rows"),
        F.count_if(~only & source).alias("dispatched_rows"),
    )


def outcome_coverage(outcomes: DataFrame) -> DataFrame:
    """Per namespace: expanded, fallback and duplicate rows. outcomes: ns, outcome, duplicate."""
    done = ~F.col("duplicate")
    return outcomes.groupBy("ns").agg(
        F.count_if(done & (F.col("outcome") == "expanded")).alias("expanded_pages"),
        F.count_if(done & ~F.coalesce(F.col("outcome") == "expanded", F.lit(False))).alias("fallback_pages"),
        F.count_if("duplicate").alias("duplicate_rows"),
        F.count("*").alias("dispatched_rows"),
    )


def merged(parts: list[DataFrame], keys: list[str], sums: list[str], identity: list[str] = []) -> DataFrame:  # noqa: B006
    """Counters of several shards added up; identity columns must agree, else they come out null."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    same = [F.when(F.count_distinct(c) <= 1, F.max(c)).alias(c) for c in identity]
    return whole.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], *same)


def violations(coverage: DataFrame, checks: dict[str, str]) -> DataFrame:
    """(the columns of coverage, rule): one row for each broken rule."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(F.expr(sql), F.lit(False)), F.lit(name)) for name, sql in checks.items()]))
    return coverage.withColumn("rule", F.explode(broken))


COVERAGE_RULES = {"classes": "compile_only_rows + source_unavailable_rows + dispatched_rows = input_rows"}
OUTCOME_RULES = {"outcomes": "expanded_pages + fallback_pages + duplicate_rows = dispatched_rows"}


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is last in the order; one comparison per row, no window."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *[c for c in rest if c not in order])).alias("b"))
    return best.select(*keys, *[F.col(f"b.{c}").alias(c) for c in rest])


def category_stats(members: DataFrame) -> DataFrame:
    """all, subcats, files and pages (the rest) of each category. members: category, kind (page, subcat, file)."""
    out = members.groupBy("category").agg(F.count("*").alias("n_all"), F.count_if(F.col("kind") == "subcat").alias("n_subcats"), F.count_if(F.col("kind") == "file").alias("n_files"))
    return out.withColumn("n_pages", F.col("n_all") - F.col("n_subcats") - F.col("n_files"))


def pages_in_category(stats: DataFrame, wanted: DataFrame, scope: str = "all") -> DataFrame:
    """(category, n) for each wanted category; an unknown one has 0."""
    columns = {"all": "n_all", "pages": "n_pages", "subcats": "n_subcats", "files": "n_files"}
    if scope not in columns:
        raise ValueError(f"unknown scope {scope}")
    return wanted.select("category").distinct().join(stats, "category", "left").select("category", F.coalesce(columns[scope], F.lit(0)).alias("n"))


def usage_counts(refs: DataFrame) -> DataFrame:
    """References per kind and target."""
    return refs.groupBy("kind", "target").agg(F.count("*").alias("n_refs"))


def envelope(rows: DataFrame, group: list[str], key: str, size: str, exact: str) -> DataFrame:
    """Per group: the greatest size and the least key that has it, the sum, and the sum of
    ``exact``, which is null once one row is inexact (null). A null size is no witness."""
    return rows.groupBy(*group).agg(
        F.max(size).alias("max_size"),
        F.min_by(key, F.when(F.col(size).isNotNull(), F.struct(-F.col(size), F.col(key)))).alias("witness"),
        F.sum(size).alias("total_size"),
        F.when(F.count(exact) == F.count("*"), F.sum(exact)).alias("exact_total"),
    )


def distinct_digests(files: DataFrame) -> DataFrame:
    """Per identity: rows, distinct digests and whether they agree."""
    return files.groupBy("identity").agg(F.count("*").alias("n_rows"), F.count_distinct("digest").alias("n_digests")).withColumn("agrees", F.col("n_digests") <= 1)


def latest_attempts(attempts: DataFrame, keys: list[str], sequence: list[str], accepted) -> DataFrame:
    """Per key: attempts (repeated rows once) and whether the latest was accepted."""
    once = attempts.distinct()
    return once.groupBy(*keys).agg(F.count("*").alias("n_attempts"), F.max_by(accepted, F.struct(*sequence)).alias("accepted"))


def reservoir(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows by the least digest of seed and key, with the population: the same distribution as a reservoir."""
    drawn = rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)
    return drawn.withColumn("population", rows.agg(F.count("*")).scalar())


def covering(ranked: DataFrame, key: str, value: str, numerator: int, denominator: int, base: int = 0, size: str | None = None) -> DataFrame:
    """The shortest prefix that covers numerator/denominator of the total value.

    Keys are ranked by value / (base + size), then key. running is the sum up to
    and with the row.
    """
    weight = F.col(value) / (F.lit(base) + F.col(size)) if size else F.col(value)
    rows = ranked.groupBy(key).agg(F.sum(value).alias(value), *([F.max(size).alias(size)] if size else []))
    placed = with_running(rows.withColumn("_w", weight.cast("double")), [F.col("_w").desc(), F.col(key)], value)
    total = rows.agg(F.sum(value)).scalar()
    out = placed.withColumn("running", F.col("running").cast("bigint")).withColumn("_total", total)
    needed = F.ceil(F.col("_total") * numerator / denominator)
    return out.where(F.col("running") - F.col(value) < needed).select(key, value, F.col("position").cast("int").alias("position"), "running")


def compile_modes(profile: DataFrame) -> DataFrame:
    """(key, mode): o2 if in any cover, o0 if neither page nor direct use reaches it, else o1.

    profile: key, page_reach, direct_reach, in_page, in_direct, in_module.
    """
    high = F.col("in_page") | F.col("in_direct") | F.col("in_module")
    none = (F.col("page_reach") == 0) & (F.col("direct_reach") == 0)
    return profile.select("key", F.when(high, "o2").when(none, "o0").otherwise("o1").alias("mode"))


# Reasons of a fallback that mean the run itself failed.
OPERATIONAL = ("timeout", "out_of_memory", "worker_died")


def fallback_problems(report: DataFrame) -> DataFrame:
    """(ns, title, problem): blank titles, empty or repeated reasons, repeated pages, operational failures.

    report: ns, title, reasons array<string>.
    """
    n = F.count("*").over(Window.partitionBy("ns", "title"))
    rows = report.withColumn("_n", n)
    problem = F.array_compact(
        F.array(
            F.when(F.trim(F.coalesce("title", F.lit(""))) == "", "blank title"),
            F.when(F.coalesce(F.size("reasons"), F.lit(0)) < 1, "no reason"),
            F.when(F.size(F.array_distinct("reasons")) < F.size("reasons"), "repeated reason"),
            F.when(F.col("_n") > 1, "repeated page"),
            F.when(F.arrays_overlap("reasons", F.array(*map(F.lit, OPERATIONAL))), "operational failure"),
        )
    )
    return rows.select("ns", "title", F.explode(problem).alias("problem")).distinct()


def merged_reasons(reports: DataFrame) -> DataFrame:
    """Per page: whether each reason was given anywhere. reports: ns, title, reason."""
    return reports.groupBy("ns", "title").agg(F.sort_array(F.collect_set("reason")).alias("reasons"), F.bool_or(F.col("reason").isNotNull()).alias("any_reason"))


def inventory_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side only, with the side: equal inventories give none."""
    columns = left.columns
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.select(*columns).exceptAll(left).withColumn("side", F.lit("right")))


def reconciled(expected: DataFrame, records: DataFrame, keys: list[str], at_least: Column | None = None) -> DataFrame:
    """(keys, expected, found): keys whose number of records does not agree with the coverage.

    expected: keys, expected; records: keys, found. Where ``at_least`` holds more
    records than expected agree too (one page can give several). A side without
    the key counts 0; no rows mean that all agree.
    """
    both = expected.join(records, keys, "full_outer").fillna(0, ["expected", "found"])
    more = F.col("found") > F.col("expected")
    wrong = F.col("found") != F.col("expected")
    return both.where(wrong if at_least is None else wrong & ~(F.coalesce(at_least, F.lit(False)) & more)).select(*keys, "expected", "found")


def page_coverage_problems(coverage: DataFrame) -> DataFrame:
    """(the columns of coverage, problem) of runs (start, limit, seen, total): not all pages that were
    asked for were seen, more were, or the run ends behind the corpus. A null limit asks for all from start on."""
    asked = F.greatest(F.least(F.coalesce("limit", F.col("total")), F.col("total") - F.col("start")), F.lit(0))
    problem = F.when(F.col("start") > F.col("total"), "start behind the end").when(F.col("seen") < asked, "pages missing").when(F.col("seen") > asked, "pages too many")
    return coverage.withColumn("problem", problem).where("problem is not null")


def strict_union(snapshots: list[DataFrame], key: str, inventory: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, problems): all rows of the snapshots, and (key, problem) of keys that stand more than
    once in any of them, or in the rows or the inventory (key) only. Without problems the union holds."""
    rows = snapshots[0]
    for more in snapshots[1:]:
        rows = rows.unionByName(more)
    problems = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key, F.lit("repeated").alias("problem"))
    if inventory is not None:
        have, want = rows.select(key).distinct(), inventory.select(key).distinct()
        problems = problems.unionByName(want.join(have, key, "left_anti").select(key, F.lit("not captured").alias("problem")))
        problems = problems.unionByName(have.join(want, key, "left_anti").select(key, F.lit("not selected").alias("problem")))
    return rows, problems


def repeats(calls: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n_calls, n_repeats): how often a call comes again with equal keys; nulls are equal."""
    return calls.groupBy(*keys).agg(F.count("*").alias("n_calls")).withColumn("n_repeats", F.col("n_calls") - 1)


def work_statistics(pages: DataFrame, group: list[str], counters: list[str]) -> DataFrame:
    """Per group: pages, and of each counter its sum, greatest value and the number of pages that have one."""
    return pages.groupBy(*group).agg(F.count("*").alias("n_pages"), *[f(c).alias(f"{c}_{n}") for c in counters for n, f in (("sum", F.sum), ("max", F.max), ("pages", F.count))])


def profile(page_edges: DataFrame, module_edges: DataFrame, page_reach: DataFrame) -> DataFrame:
    """(node, page_reach, direct_reach, module_reach, fan_in) of every module.

    page_edges: page, node, the modules a page calls; module_edges: src, dst, which
    module loads which; page_reach: node, value, the pages that reach it. direct_reach
    counts the pages that call it, module_reach the reach of the modules that load it,
    fan_in the modules that do. Repeated edges count once.
    """
    loads = module_edges.where("src is not null and dst is not null and src <> dst").select("src", "dst").distinct()
    direct = page_edges.where("node is not null").groupBy("node").agg(F.count_distinct("page").alias("direct_reach"))
    known = page_reach.where("node is not null").groupBy("node").agg(F.max("value").alias("page_reach"))
    loaded = loads.join(known.withColumnRenamed("node", "src"), "src", "left").groupBy(F.col("dst").alias("node")).agg(F.sum(F.coalesce("page_reach", F.lit(0))).alias("module_reach"), F.count("*").alias("fan_in"))
    nodes = direct.select("node").union(known.select("node")).union(loads.select("src")).union(loads.select("dst")).distinct()
    joined = nodes.join(known, "node", "left").join(direct, "node", "left").join(loaded, "node", "left")
    return joined.fillna(0, ["page_reach", "direct_reach", "module_reach", "fan_in"]).select("node", "page_reach", "direct_reach", "module_reach", "fan_in")


def page_coverage_record(pages: DataFrame, start: int, limit: int | None, identity: str) -> DataFrame:
    """One row start, limit, seen, total, identity: what a run over the ordered pages asked for and saw."""
    one = pages.agg(F.count("*").alias("total"))
    most = F.greatest(F.col("total") - start, F.lit(0))
    return one.select(F.lit(start).cast("long").alias("start"), F.lit(limit).cast("long").alias("limit"), (most if limit is None else F.least(most, F.lit(limit))).alias("seen"), "total", F.lit(identity).alias("identity"))
