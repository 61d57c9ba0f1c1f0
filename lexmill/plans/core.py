"""The reference operators as named queries over the test tables, with their SQL.

``query`` registers a function under its name with the SQL that gives the same
rows; operators that SQL cannot express have none and are tested elsewhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import accounting as A
from lexmill.operators import entries, expansion, graphs, ranks, reader, resolution
from lexmill.operators import sequences as Q
from lexmill.operators.snapshots import instant
from lexmill.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


def _titles(s, d):
    return table(s, d, "pages").select("id", "ns", "title").distinct()


_T = "(select distinct id, ns, title from pages)"

# ---- accounting ---------------------------------------------------------------------


@query("""select coalesce(lang, '') as code, case coalesce(lang, '') when 'mul' then 'translingual' when '' then 'unverified' else 'language' end as kind,
  count(*) as n_records, cast(sum(n_chars) as bigint) as n_chars from documents group by all""")
def language_accounting(s, d):
    code = F.coalesce("lang", F.lit(""))
    kind = F.when(code == "mul", "translingual").when(code == "", "unverified").otherwise("language")
    return table(s, d, "documents").select(code.alias("code"), kind.alias("kind"), "n_chars").groupBy("code", "kind").agg(F.count("*").alias("n_records"), F.sum("n_chars").alias("n_chars"))


def _bundle(s, d):
    roles = table(s, d, "namespace_registry").select(F.col("id").alias("ns"), F.col("ns_role").alias("role"))
    return table(s, d, "bundle_pages").select("ns", "has_source").join(F.broadcast(roles), "ns", "left")


_COVER = """select ns, count(*) as input_rows, count(*) filter (ns_role = 'compile_only') as compile_only_rows,
  count(*) filter (ns_role <> 'compile_only' and not coalesce(has_source, false)) as source_unavailable_rows,
  count(*) filter (ns_role <> 'compile_only' and coalesce(has_source, false)) as dispatched_rows
  from bundle_pages b left join (select id, ns_role from namespace_registry) r on r.id = b.ns group by ns"""


@query(_COVER)
def coverage_inputs(s, d):
    return A.input_coverage(_bundle(s, d))


@query(f"select c.*, 'classes' as rule from ({_COVER}) c where compile_only_rows + source_unavailable_rows + dispatched_rows <> input_rows")
def coverage_violations(s, d):
    return A.violations(A.input_coverage(_bundle(s, d)), A.COVERAGE_RULES)


@query(f"select ns, cast(sum(input_rows) as bigint) as input_rows, cast(sum(dispatched_rows) as bigint) as dispatched_rows from ({_COVER} union all {_COVER}) group by ns")
def coverage_merged(s, d):
    one = A.input_coverage(_bundle(s, d))
    return A.merged([one, one], ["ns"], ["input_rows", "dispatched_rows"])


@query("""with r as (select distinct request_id, page_id, outcome from bundle_expander), n as (select id, min(ns) as ns from pages group by id),
  x as (select coalesce(n.ns, -99) as ns, r.outcome, e.n > 1 as dup from r left join n on n.id = r.page_id join (select request_id, count(*) as n from bundle_expander group by 1) e using (request_id))
  select ns, count(*) filter (not dup and outcome = 'expanded') as expanded_pages, count(*) filter (not dup and coalesce(outcome <> 'expanded', true)) as fallback_pages,
  count(*) filter (dup) as duplicate_rows, count(*) as dispatched_rows from x group by ns""")
def coverage_outcomes(s, d):
    rows = table(s, d, "bundle_expander").groupBy("request_id", "page_id", "outcome").agg(F.count("*").alias("n"))
    n = rows.groupBy("request_id").agg(F.sum("n").alias("total"))
    ns = table(s, d, "pages").groupBy(F.col("id").alias("page_id")).agg(F.min("ns").alias("ns"))
    out = rows.join(n, "request_id").join(ns, "page_id", "left").select(F.coalesce("ns", F.lit(-99)).alias("ns"), "outcome", (F.col("total") > 1).alias("duplicate"))
    return A.outcome_coverage(out)


@query("""select page_id, count(*) as n_attempts, arg_max_null(outcome = 'expanded', (requested_at, request_id)) as accepted
  from (select distinct page_id, request_id, requested_at, outcome from bundle_expander) group by page_id""")
def attempts_latest(s, d):
    rows = table(s, d, "bundle_expander").select("page_id", "request_id", "requested_at", "outcome")
    return A.latest_attempts(rows, ["page_id"], ["requested_at", "request_id"], F.col("outcome") == "expanded")


@query("""select worker_slot, cast(max(length(source)) as int) as max_size, min(request_id) filter (length(source) = m) as witness, cast(sum(length(source)) as bigint) as total_size,
  case when count(duration_ms) = count(*) then round(sum(duration_ms), 3) end as exact_total
  from (select *, max(length(source)) over (partition by worker_slot) as m from bundle_expander) group by worker_slot""")
def reader_envelope(s, d):
    rows = table(s, d, "bundle_expander").select("worker_slot", "request_id", F.char_length("source").alias("size"), "duration_ms")
    return A.envelope(rows, ["worker_slot"], "request_id", "size", "duration_ms").withColumn("exact_total", F.round("exact_total", 3))


@query("""select revision_id as identity, count(*) as n_rows, count(distinct md5(coalesce(source, ''))) as n_digests, count(distinct md5(coalesce(source, ''))) <= 1 as agrees from bundle_pages group by 1""")
def digests_per_identity(s, d):
    return A.distinct_digests(table(s, d, "bundle_pages").select(F.col("revision_id").alias("identity"), F.md5(F.coalesce("source", F.lit(""))).alias("digest")))


@query("""with m as (select target, case kind when 1 then 'subcat' else 'page' end as kind from (select distinct link_id, target, kind from links) where target is not null)
  select target as category, count(*) as n_all, count(*) filter (kind = 'subcat') as n_subcats, 0::bigint as n_files, count(*) filter (kind = 'page') as n_pages from m group by 1""")
def category_statistics(s, d):
    m = table(s, d, "links").where("target is not null").select("link_id", "target", "kind").distinct()
    return A.category_stats(m.select(F.col("target").alias("category"), F.when(F.col("kind") == 1, "subcat").otherwise("page").alias("kind")))


@query("""with s as (select target, count(*) filter (kind = 1) as n from (select distinct link_id, target, kind from links) where target is not null group by 1)
  select t.id as category, coalesce(n, 0) as n from (select distinct id from targets) t left join s on s.target = t.id""")
def pages_in_category(s, d):
    return A.pages_in_category(category_statistics(s, d), table(s, d, "targets").select(F.col("id").alias("category")), "subcats")


@query("""with u as (select target, count(*) as n from links where target is not null group by 1),
  r as (select target, n, row_number() over (order by n desc, target) as position, sum(n) over (order by n desc, target rows unbounded preceding) as running, sum(n) over () as total from u)
  select target, n, cast(position as int) as position, cast(running as bigint) as running from r where running - n < ceil(total * 80 / 100)""")
def usage_cover(s, d):
    return A.covering(table(s, d, "links").where("target is not null").groupBy("target").agg(F.count("*").alias("n")), "target", "n", 80, 100)


_COVERED = """(select key from (select key, n, sum(n) over (order by n / (1 + size) desc, key rows unbounded preceding) - n as before, sum(n) over () as total from {}) where before < ceil(total * {} / 1000))"""


@query(f"""with l as (select distinct link_id, target, kind, from_id from links where target is not null), k as (select distinct id as key, length(title) as size from targets),
  s as (select key, max(size) as size from k group by 1),
  g as (select s.key, s.size, count(distinct from_id) as page, count(from_id) filter (kind = 0) as direct, count(from_id) filter (kind = 1) as module from s left join l on l.target = s.key group by all),
  p as (select key, page as n, size from g), di as (select key, direct as n, size from g), m as (select key, module as n, size from g)
  select key, case when key in {_COVERED.format('p', 995)} or key in {_COVERED.format('di', 950)} or key in {_COVERED.format('m', 980)} then 'o2' when page = 0 and direct = 0 then 'o0' else 'o1' end as mode from g""")
def mode_selection(s, d):
    """Three covers, each of its own signal by reach over size: 99.5 % of pages, 95 % of direct uses, 98 % of subcategories."""
    links = table(s, d, "links").where("target is not null").select("link_id", F.col("target").alias("key"), "kind", "from_id").distinct()
    sizes = table(s, d, "targets").select(F.col("id").alias("key"), F.char_length("title").alias("size")).groupBy("key").agg(F.max("size").alias("size"))
    count = lambda kind: F.count(F.when(F.col("kind") == kind, F.col("from_id")))
    rows = sizes.join(links, "key", "left").groupBy("key", "size").agg(F.count_distinct("from_id").alias("page_reach"), count(0).alias("direct_reach"), count(1).alias("module_reach"))
    profile = rows
    for signal, share in (("page", 995), ("direct", 950), ("module", 980)):
        inside = A.covering(rows, "key", f"{signal}_reach", share, 1000, 1, "size").select("key", F.lit(True).alias(f"in_{signal}"))
        profile = profile.join(inside, "key", "left").fillna(False, [f"in_{signal}"])
    return A.compile_modes(profile)


@query("""with r as (select ns, title, list_distinct(list(outcome order by outcome) filter (outcome is not null and outcome <> 'expanded')) as x from
   (select distinct p.ns, e.title, e.outcome from bundle_expander e join (select id, min(ns) as ns from pages group by 1) p on p.id = e.page_id) group by all)
  select ns, title, array_to_string(list_sort(coalesce(x, [])), ',') as reasons, coalesce(len(x), 0) > 0 as any_reason from r""")
def fallback_reasons(s, d):
    ns = table(s, d, "pages").groupBy(F.col("id").alias("page_id")).agg(F.min("ns").alias("ns"))
    rows = table(s, d, "bundle_expander").select("page_id", "title", F.when(F.col("outcome") != "expanded", F.col("outcome")).alias("reason")).join(ns, "page_id")
    return A.merged_reasons(rows.select("ns", "title", "reason")).withColumn("reasons", F.array_join("reasons", ","))


@query("""with r as (select n.ns, e.title, e.outcome from bundle_expander e left join (select id, min(ns) as ns from pages group by 1) n on n.id = e.page_id where e.outcome is null or e.outcome <> 'expanded'),
  p as (select ns, title, count(*) as n, count(outcome) as n_reasons, count(distinct outcome) as n_different, count(*) filter (outcome in ('timeout', 'out_of_memory', 'worker_died')) as n_failed, count(*) filter (outcome is null) as n_none from r group by all)
  select ns, title, 'blank title' as problem from p where trim(coalesce(title, ''), ' ') = '' union all select ns, title, 'no reason' from p where n_none > 0 union all select ns, title, 'repeated reason' from p where n_different < n_reasons
  union all select ns, title, 'repeated page' from p where n > 1 union all select ns, title, 'operational failure' from p where n_failed > 0""")
def fallback_report_problems(s, d):
    """Every problem of the report: its rows one by one, null outcomes as rows without a
    reason, and the reasons of each page together, as a row alone repeats none."""
    ns = table(s, d, "pages").groupBy(F.col("id").alias("page_id")).agg(F.min("ns").alias("ns"))
    rows = table(s, d, "bundle_expander").where("outcome is null or outcome <> 'expanded'").join(ns, "page_id", "left").select("ns", "title", "outcome")
    single = rows.select("ns", "title", F.array_compact(F.array("outcome")).alias("reasons"))
    pages = rows.groupBy("ns", "title").agg(F.collect_list("outcome").alias("reasons"))
    return A.fallback_problems(single).unionByName(A.fallback_problems(pages)).distinct()


@query("select id, title, count(*) as n_rows from pages group by all having count(*) > 1")
def duplicate_rows(s, d):
    return A.duplicates(table(s, d, "pages"), ["id", "title"])


@query("""select title, id, first_seen from (select *, row_number() over (partition by title order by first_seen desc nulls last, id desc) as rn from pages) where rn = 1""")
def canonical_titles(s, d):
    return A.last_wins(table(s, d, "pages").select("title", "first_seen", "id"), ["title"], ["first_seen", "id"]).select("title", "id", "first_seen")


@query("""with a as (select distinct id, title from targets), b as (select distinct id, replace(category_key, 'x', 'x') as title from pages where category_key is not null)
  select title, 'left' as side from (select title from a except all select title from b) union all select title, 'right' from (select title from b except all select title from a)""")
def inventory_difference(s, d):
    a = table(s, d, "targets").select("id", "title").distinct().select("title")
    b = table(s, d, "pages").where("category_key is not null").select("id", F.col("category_key").alias("title")).distinct().select("title")
    return A.inventory_difference(a, b)


@query("""select id, title, population from (select id, title, count(*) over () as population, row_number() over (order by md5('7:' || id), id) as rn from (select distinct id, title from pages where ns = 0)) where rn <= 10""")
def reservoir_sample(s, d):
    return A.reservoir(table(s, d, "pages").where("ns = 0").select("id", "title").distinct(), "id", 10, 7)


# ---- reader -------------------------------------------------------------------------


@query(f"select id, ns, title from {_T} where title = (select max(title) from pages where ns = 0)")
def lookup_exact(s, d):
    wanted = table(s, d, "pages").where("ns = 0").agg(F.max("title")).first()[0]
    return reader.exact(_titles(s, d), wanted)


def _lower(x: str) -> str:
    """SQL of the lower case of x: unlike lower() alone, a sigma that ends a word is final and İ keeps its dot."""
    return f"lower(replace(regexp_replace({x}, '(\\p{{L}}\\p{{M}}*)Σ(\\p{{M}}*)($|[^\\p{{L}}\\p{{M}}])', '\\1ς\\2\\3', 'g'), 'İ', 'i' || chr(775)))"


@query(f"""with q as (select distinct title as query, {_lower('title')} as l from bundle_pages where title is not null), e as (select distinct title, {_lower('title')} as l from pages where title is not null),
  b as (select q.query, min_by(e.title, (e.title <> q.query, e.title)) as title from q join e using (l) group by 1)
  select q.query, b.title, b.title = q.query as exact from q left join b using (query)""")
def lookup_folded(s, d):
    wanted = table(s, d, "bundle_pages").where("title is not null").select(F.col("title").alias("query"))
    return reader.folded_many(reader.prepared(_titles(s, d)), wanted)


@query(f"""with m as (select title, id, {_lower('title')} as title_lc from {_T}), h as (select * from m where starts_with(title_lc, 'ca'))
  select id, title, (select count(*) from h) as total, 5 + 20 < (select count(*) from h) as has_more from (select * from h order by title_lc, title, id limit 20 offset 5)""")
def search_page(s, d):
    hits = reader.prefix(reader.prepared(_titles(s, d).select("id", "title")), "ca", "title_lc")
    return reader.page(hits, ["title_lc", "title", "id"], 20, 5).select("id", "title", "total", "has_more")


@query(f"""with m as (select title, id, {_lower('title')} as title_lc from {_T}), h as (select * from m where starts_with(title_lc, 'с'))
  select id, title, (select count(*) from h) as total, 1000 < (select count(*) from h) as has_more from (select * from h order by title_lc, title limit 1000)""")
def search_accented(s, d):
    return reader.search(reader.prepared(_titles(s, d).select("id", "title")), " С ", 1000).select("id", "title", "total", "has_more")


@query(f"select id, title from {_T} where starts_with(title, 'Category:B')")
def prefix_bytes(s, d):
    return reader.prefix(_titles(s, d), "Category:B").select("id", "title")


@query("""with t as (select id, title, row_number() over (order by id, title) as position from (select distinct id, title from pages where title is not null))
  select id, title, cast(position as bigint) as position, cast((position - 11) // 50 as int) as shard from t where position > 10 and position <= 510""")
def page_shards(s, d):
    rows = table(s, d, "pages").where("title is not null").select("id", "title").distinct()
    return ranks.shards(rows, ["id", "title"], 10, 500, 50)


_ALIAS = """with a as (select distinct ns as kind, cast(id as varchar) as title, replace(title, '_', ' ') as target from redirects where title is not null and coalesce(interwiki, '') = ''),
  f as (select distinct title, ns as kind from pages where title is not null),
  b as (select a.kind, a.title, a.target, min(f.kind <> a.kind) as other, min_by(f.kind, (f.kind <> a.kind, f.kind)) as def_kind from a left join f on f.title = a.target group by all)
  select kind, title, target, case when def_kind = kind then 'same kind' when def_kind is not null then 'other kind' else 'unfollowed' end as resolution, def_kind as target_kind from b"""


@query(_ALIAS)
def alias_one_hop(s, d):
    a = table(s, d, "redirects").where("title is not null and coalesce(interwiki, '') = ''").select(F.col("ns").alias("kind"), F.col("id").cast("string").alias("title"), F.translate("title", "_", " ").alias("target")).distinct()
    return reader.aliases_resolved(a, table(s, d, "pages").where("title is not null").select(F.col("ns").alias("kind"), "title"))


@query("""select ns as kind, title, count(*) as n_rows from (select ns, title from (select distinct id, ns, title from pages) union all select ns, title from (select distinct id, ns, replace(title, '_', ' ') as title from redirects)) group by all having count(*) > 1""")
def overlay_conflicts(s, d):
    a = table(s, d, "redirects").select("id", F.col("ns").alias("kind"), F.translate("title", "_", " ").alias("title")).distinct()
    return reader.overlay_conflicts(a, _titles(s, d).withColumnRenamed("ns", "kind"))


# ---- joins and sets -----------------------------------------------------------------


@query("""with l as (select distinct link_id, target, kind, sortkey, from_id from links where target is not null), r as (
  select t.title as category, l.kind, l.sortkey, l.from_id, l.link_id, row_number() over (partition by t.title order by l.kind, l.sortkey nulls first, l.from_id, l.link_id) as rn
  from l join (select distinct id, title from targets) t on t.id = l.target join (select distinct id from pages) p on p.id = l.from_id)
  select category, kind, sortkey, from_id, link_id, cast(rn as int) as rank from r where rn <= 200""")
def category_members(s, d):
    links = table(s, d, "links").where("target is not null").select("link_id", "target", "kind", "sortkey", "from_id").distinct()
    targets = table(s, d, "targets").select(F.col("id").alias("target"), F.col("title").alias("category")).distinct()
    return _first_members(links, targets, table(s, d, "pages"))


@query("""with l as (select distinct link_id, target, kind, sortkey, from_id from links where target is not null), r as (
  select t.title as category, l.kind, l.sortkey, l.from_id, l.link_id, row_number() over (partition by t.title order by l.kind, l.sortkey nulls first, l.from_id, l.link_id) as rn
  from l join (select distinct id, title from targets) t on t.id = l.target join (select distinct id from pages where ns = 0) p on p.id = l.from_id)
  select category, kind, sortkey, from_id, link_id, cast(rn as int) as rank from r where rn <= 200""")
def category_members_main(s, d):
    """The main scope: the first 200 members of namespace 0."""
    links = table(s, d, "links").where("target is not null").select("link_id", "target", "kind", "sortkey", "from_id").distinct()
    targets = table(s, d, "targets").select(F.col("id").alias("target"), F.col("title").alias("category")).distinct()
    return _first_members(links, targets, table(s, d, "pages").where("ns = 0"))


def _first_members(links, targets, pages):
    pages = pages.select(F.col("id").alias("from_id")).distinct()
    rows = links.join(targets, "target").join(pages, "from_id").select("category", "kind", "sortkey", "from_id", "link_id")
    return ranks.first_per_group(rows, ["category"], [F.col("kind"), F.col("sortkey").asc_nulls_first(), F.col("from_id"), F.col("link_id")], 200)


@query("""select title, 'no members' as problem from (select distinct id, title from targets) t where not exists (select 1 from links l where l.target = t.id)
  union all select category_key, 'no target' from (select distinct category_key from pages where category_key is not null) p where category_key not in (select title from targets where title is not null)
  union all select title, 'no page' from (select distinct id, title from targets where title is not null) t where title not in (select category_key from pages where category_key is not null)""")
def missing_categories(s, d):
    targets = table(s, d, "targets").select("id", "title").distinct()
    pages = table(s, d, "pages").where("category_key is not null").select(F.col("category_key").alias("title")).distinct()
    empty = targets.join(table(s, d, "links").select(F.col("target").alias("id")).distinct(), "id", "left_anti").select("title", F.lit("no members").alias("problem"))
    lone = pages.join(targets.select("title"), "title", "left_anti").select("title", F.lit("no target").alias("problem"))
    bare = targets.where("title is not null").join(pages, "title", "left_anti").select("title", F.lit("no page").alias("problem"))
    return empty.union(lone).union(bare)


@query("""select b.title, count(distinct p.id) > 0 as found from (select distinct title from bundle_pages where title is not null) b left join pages p on p.title = b.title group by 1""")
def titles_exist(s, d):
    wanted = table(s, d, "bundle_pages").where("title is not null").select("title").distinct()
    have = table(s, d, "pages").select("title", F.lit(True).alias("f")).distinct()
    return wanted.join(have, "title", "left").select("title", F.coalesce("f", F.lit(False)).alias("found"))


@query("""select lang, count(*) as n_titles from (select distinct lang, page_id from documents where page_id is not null) where page_id in (select id from pages where deleted_at is null) group by 1""")
def languages_with_title(s, d):
    live = table(s, d, "pages").where("deleted_at is null").select(F.col("id").alias("page_id")).distinct()
    return table(s, d, "documents").where("page_id is not null").select("lang", "page_id").distinct().join(live, "page_id", "left_semi").groupBy("lang").agg(F.count("*").alias("n_titles"))


# ---- ordered rows -------------------------------------------------------------------


@query("""with l as (select user_id, event_type, max((ts, event_id)) as latest from events group by all)
  select user_id, event_type, cast(rn as int) as rank from (select *, row_number() over (partition by user_id order by latest desc, event_type) as rn from l) where rn <= 3""")
def history_recency(s, d):
    return Q.recency(table(s, d, "events"), "user_id", "event_type", ["ts", "event_id"], 3)


@query("""select user_id, event_type, count(*) as n_toggles, max_by(ts, (ts, event_id)) as ts, max_by(event_id, (ts, event_id)) as event_id from events group by user_id, event_type having count(*) % 2 = 1""")
def bookmark_toggles(s, d):
    return Q.toggles(table(s, d, "events"), "user_id", "event_type", ["ts", "event_id"])


@query("""select event_id, user_id, cast(sum(case when value >= 50 then 1 else 0 end) over w as bigint) as n_right, cast(sum(case when value >= 50 then 0 else 1 end) over w as bigint) as n_wrong
  from events window w as (partition by user_id order by ts, event_id rows unbounded preceding)""")
def quiz_score(s, d):
    rows = table(s, d, "events").select("event_id", "user_id", "ts", "value")
    return Q.running_score(rows, "user_id", ["ts", "event_id"], F.col("value") >= 50).select("event_id", "user_id", "n_right", "n_wrong")


@query("""with r as (select doc_id, n_chars, sum(n_chars) over (order by collected_at desc, doc_id desc rows unbounded preceding) as run from (select doc_id, coalesce(n_chars, 0) as n_chars, collected_at from documents where collected_at is not null))
  select doc_id, run <= 100000 as keep from r""")
def evict_oldest(s, d):
    rows = table(s, d, "documents").where("collected_at is not null").select("doc_id", F.coalesce("n_chars", F.lit(0)).alias("n_chars"), "collected_at")
    return Q.evict_oldest(rows, ["collected_at", "doc_id"], "n_chars", 100_000).select("doc_id", "keep")


@query("""with e as (select user_id, list(distinct event_type order by event_type) as a from events group by 1),
  x as (select user_id, a as latest, list_filter(a, lambda x: x <> 'view') as local, a[2:] as base from e)
  select user_id, array_to_string(list_concat(list_filter(local, lambda x: not list_contains(base, x)), list_filter(latest, lambda x: not list_contains(list_filter(base, lambda y: not list_contains(local, y)), x) and not list_contains(list_filter(local, lambda y: not list_contains(base, y)), x)))[:4], ',') as merged from x""")
def three_way_merge(s, d):
    e = table(s, d, "events").groupBy("user_id").agg(F.sort_array(F.collect_set("event_type")).alias("a"))
    local, base = F.filter("a", lambda x: x != "view"), F.slice("a", 2, 100)
    return e.select("user_id", F.array_join(Q.merge_lists(base, local, F.col("a"), 4), ",").alias("merged"))


@query("""with l as (select doc_id, generate_subscripts(x, 1) - 1 as ord, unnest(x) as line from (select doc_id, string_split_regex(text, '\\r?\\n') as x from documents where text is not null)),
  p as (select doc_id, ord, line, regexp_extract(line, '^[#*:;]+') as prefix from l)
  select case when prefix = '' then case when trim(line, ' ') = '' then 'blank' else 'paragraph' end when prefix[1] = '#' then case prefix[-1] when '#' then 'definition' when ':' then 'example' when '*' then 'quotation' else 'list_detail' end
    when prefix[-1] in ('*', '#') then 'list_item' when prefix[-1] = ';' then 'term' when contains(prefix, '*') then 'list_detail' else 'indent' end as kind,
    cast(length(prefix) as int) as depth, count(*) as n_lines from p group by all""")
def line_kinds(s, d):
    return Q.blocks(table(s, d, "documents").where("text is not null"), ["doc_id"], "text").groupBy("kind", "depth").agg(F.count("*").alias("n_lines"))


def _wiki_sources(s, d):
    return table(s, d, "bundle_pages").where("source is not null and source <> ''").select("revision_id", "title", "source").distinct()


@query()
def page_sections(s, d):
    return Q.section_rows(_wiki_sources(s, d), ["revision_id"], "source", (1, 2, 3, 4, 5, 6)).drop("source")


@query()
def section_languages(s, d):
    names = s.createDataFrame([("English", "en"), ("German", "de"), ("French", "fr")], "name string, code string")
    rows = Q.section_rows(_wiki_sources(s, d), ["revision_id"], "source", (1, 2))
    return Q.language_groups(Q.resolved_languages(rows, ["revision_id"], names, "und"), ["revision_id"])


@query()
def sense_layout(s, d):
    return Q.sense_layout(Q.blocks(_wiki_sources(s, d), ["revision_id"], "source"), ["revision_id"])


@query()
def lexeme_layout(s, d):
    return Q.lexemes(Q.heading_rows(_wiki_sources(s, d), ["revision_id"], "source"), ["revision_id"])


# ---- graphs and templates -----------------------------------------------------------


@query()
def template_references(s, d):
    return graphs.references(_wiki_sources(s, d), ["revision_id"], "source")


@query()
def template_usage(s, d):
    return A.usage_counts(template_references(s, d).where("target is not null"))


def _parents(s, d):
    links = table(s, d, "links").where("kind = 1 and target is not null").select("from_id", "target").distinct()
    pages = table(s, d, "pages").where("category_key is not null").select(F.col("id").alias("from_id"), F.col("category_key").alias("title")).distinct()
    targets = table(s, d, "targets").select("id", "title").distinct()
    return links.join(pages, "from_id").join(targets, "title").select(F.col("target").alias("src"), F.col("id").alias("dst")).distinct()


_EDGES = """e as (select distinct l.target as src, t.id as dst from (select distinct from_id, target from links where kind = 1 and target is not null) l
  join (select distinct id, category_key from pages where category_key is not null) p on p.id = l.from_id join (select distinct id, title from targets) t on t.title = p.category_key)"""


@query(f"""with recursive {_EDGES}, roots as (select distinct src as node from e where src not in (select dst from e)), r as (select node from roots union select e.dst from r join e on e.src = r.node)
  select node from r""")
def graph_closure(s, d):
    e = _parents(s, d)
    roots = e.select(F.col("src").alias("node")).distinct().join(e.select(F.col("dst").alias("node")), "node", "left_anti")
    return graphs.reachable(e, roots).select("node")


@query(f"""with recursive {_EDGES}, r as (select src, dst from e union select r.src, e.dst from r join e on e.src = r.dst),
  n as (select src as node from e union select dst from e), m as (select n.node, (select min(a.dst) from r a join r b on b.src = a.dst and b.dst = a.src where a.src = n.node) as low from n)
  select node, coalesce(low, node) as component from m""")
def graph_components(s, d):
    e = _parents(s, d)
    return graphs.components(e, e.select(F.col("src").alias("node")).union(e.select("dst")))


def _templates(s, d):
    """(name, source) of the template pages that have a source: that of the newest snapshot, then revision."""
    rows = table(s, d, "bundle_pages").where("ns = 10 and title is not null and source is not null")
    newest = F.max_by("source", F.struct(F.col("snapshot_id"), instant("revision_timestamp"), F.col("revision_id"), F.col("source")))
    return rows.groupBy(F.regexp_replace("title", "^[^:]*:", "").alias("name")).agg(newest.alias("source"))


@query()
def pages_expanded(s, d):
    """Templates are the newest sources of the template pages; these four names have one only where no page has.
    What ``#ifexist`` finds are the titles of pages."""
    pages = _wiki_sources(s, d)
    usual = s.createDataFrame([("m", "''{{{2}}}''{{#if:{{{tr|}}}| ({{{tr}}})}}"), ("l", "[[{{{2}}}]]"), ("lb", "({{{2|}}})"), ("q", "({{{1}}}: {{{2|}}})")], "name string, source string")
    stored = _templates(s, d)
    return expansion.expanded(pages, stored.unionByName(usual.join(stored, "name", "left_anti")), ["revision_id"], titles=table(s, d, "pages").select("title"))


# ---- entries, names -----------------------------------------------------------------


def _entries(s, d):
    pages = _wiki_sources(s, d).select("revision_id", "title", F.lit("en").alias("language"), "source")
    return entries.compiled(pages, ["revision_id"])


@query()
def entries_compiled(s, d):
    return _entries(s, d)


@query("""select revision_id, title <> '' and revision_id % 3 = 0 as valid from (select distinct revision_id, title, source from bundle_pages where source is not null and source <> '')""")
def entries_valid(s, d):
    """Compiled entries are valid; a third of them is left as it is, a third loses its title, a third gets a section of its own that is not there."""
    third = F.col("revision_id") % 3
    entry = F.col("entry").withField("title", F.when(third == 1, "").otherwise(F.col("entry.title")))
    other = F.col("entry.other_sections")
    entry = entry.withField("other_sections", F.when(third == 2, F.array_append(other, F.size("entry.sections"))).otherwise(other))
    return _entries(s, d).select("revision_id", entries.is_valid(entry).alias("valid"))


@query()
def entries_text(s, d):
    e = F.col("entry")
    return _entries(s, d).select("revision_id", entries.plain_text(e).alias("text"), entries.metrics(e).alias("m")).select("revision_id", "text", "m.*")


@query("""select title, coalesce(id, 0) as ns, case when id is not null then trim(substring(title, instr(title, ':') + 1), ' ') else title end as rest
  from (select distinct title from pages where title is not null) p left join (select distinct id, lower(name) as k from namespace_registry where name <> '' union select distinct id, lower(canonical_name) from namespace_registry where canonical_name <> '') n
  on contains(p.title, ':') and n.k = lower(split_part(p.title, ':', 1))""")
def title_namespaces(s, d):
    return resolution.namespaces(table(s, d, "pages").where("title is not null"), table(s, d, "namespace_registry"))


@query("""with c as (select distinct lang as code from documents where lang is not null)
  select upper(code) as name, code, 'L' || code as heading from c union all select ' l' || code || '_', code, 'L' || code from c union all select 'Old ' || code, code, 'L' || code from c union all select code || '?', null, null from c""")
def language_names(s, d):
    """Names by code, canonical name and alias, in any case and spacing; the registry has all languages of the table."""
    codes = table(s, d, "documents").where("lang is not null").select(F.col("lang").alias("code")).distinct()
    kinds = {"canonical": F.concat(F.lit("L"), "code"), "alias": F.concat(F.lit("old "), "code"), "code": F.col("code")}
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), name.alias("name")) for k, name in kinds.items()])).alias("r")
    registry = codes.select("code", rows).select("code", "r.kind", "r.name", F.lit(True).alias("trusted"))
    asked = F.array(F.upper("code"), F.concat(F.lit(" l"), "code", F.lit("_")), F.concat(F.lit("Old "), "code"), F.concat("code", F.lit("?")))
    return resolution.languages(codes.select(F.explode(asked).alias("name")), registry)


@query("""with t as (select title, row_number() over (order by md5('11:' || title), title) - 1 as i from (select distinct title from pages where title is not null)),
  d as (select title, i, least((select count(*) from t), 100) as n from t where i < 100),
  a as (select list(title order by i) as deck from d),
  c as (select title, [deck[(i + k) % n + 1] for k in [1, 2, 3]] as others, ascii(md5('12:' || title)) % 4 as place from d, a)
  select title, array_to_string(list_concat(list_concat(others[:place], [title]), others[place + 1:]), '|') as choices from c""")
def study_cards(s, d):
    cards = resolution.study_cards(table(s, d, "pages").where("title is not null"), 4, 11, 100)
    return cards.withColumn("choices", F.array_join("choices", "|"))
