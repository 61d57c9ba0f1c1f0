"""Further scalars, names, titles and accounts over whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.functions import collections as C
from lexmill.functions import dates as D
from lexmill.functions import numbers as N
from lexmill.functions import strings as S
from lexmill.functions import texts as X
from lexmill.functions import titles as T
from lexmill.functions import uris as U
from lexmill.operators import accounting as A
from lexmill.operators import graphs, nested, orphans, resolution, wikibase
from lexmill.plans.core import _EDGES, _T, _lower, _parents, _titles, query
from lexmill.plans.pipeline import _NESTED
from lexmill.plans.scalars import _P, _WIKI_URL, _pages
from lexmill.session import table

# ---- scripts' values ----------------------------------------------------------------


@query("""select l_orderkey, l_linenumber, 'n=' || l_orderkey || ' ' || lpad(cast(l_linenumber as varchar), 3, '0') as plain, printf('%x', l_partkey) as hex, printf('%.2f', l_extendedprice) as price, '[' || lpad(l_returnflag, 5, ' ') || ']' as padded, '[' || rpad(l_linestatus, 3, ' ') || ']100%' as filled,
  pow(l_linenumber, 2) as squared, cast(('0x' || substr(md5('7:' || l_orderkey || ':' || l_linenumber), 1, 13))::bigint as double) / 4503599627370496.0 as unit, l_quantity is not distinct from l_discount as same, 'number' as kind, 'string' as text_kind from lineitem""")
def lua_values(s, d):
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    return table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", S.format_string("n=%d %03d", k, n).alias("plain"), S.format_string("%x", F.col("l_partkey")).alias("hex"), S.format_string("%.2f", F.col("l_extendedprice")).alias("price"), S.format_string("[%5s]", F.col("l_returnflag")).alias("padded"),
        S.format_string("[%-3s]100%%", F.col("l_linestatus")).alias("filled"), N.power(n, F.lit(2)).alias("squared"), N.random_between(7, k, n).alias("unit"), N.same_value("l_quantity", "l_discount").alias("same"), N.value_type(n, "int").alias("kind"), N.value_type(F.col("l_returnflag"), "string").alias("text_kind"),
    )


@query(f"""select id, title, left(title, 3) as cut, '"' || replace(title, '"', '\\"') || '"' as quoted, case when length(title) < 20 then lpad(title, 20, ' ') else title end as wide, nullif(instr(title, ' '), 0)::int as blank, '{{"a":' || id || ',"b":null}}' as dumped, upper(left(hex({_lower('title')}), 4)) as fold2 from {_P}""")
def lua_texts(s, d):
    t = F.col("title")
    return _pages(s, d).select(
        "id", "title", S.format_string("%.3s", t).alias("cut"), S.format_string("%q", t).alias("quoted"), S.format_string("%20s", t).alias("wide"), F.nullif(F.instr(t, " "), F.lit(0)).alias("blank"),
        C.dump(F.struct(F.col("id").alias("a"), F.lit(None).cast("string").alias("b"))).alias("dumped"), F.hex(S.folded_prefix(t)).alias("fold2"),
    )


@query("""with w as (select user_id, list(distinct event_type order by event_type) as a from events group by 1), m as (select user_id, a, len(a) as n from w)
  select user_id, a[1] || '=1' as first_pair, n as n_pairs, array_to_string(a[2:], ',') as unpacked, case when n >= 2 then 2 end as second, array_to_string(a[:n - 1], ',') as removed, a[n] as last, array_to_string(a, '-') as joined, case when n >= 2 then a[2] end as after_first, 99 as set_value, n::int as max_key from m""")
def lua_tables(s, d):
    w = table(s, d, "events").groupBy("user_id").agg(F.sort_array(F.collect_set("event_type")).alias("a"))
    places = F.transform("a", lambda x, i: i + 1)
    w = w.withColumn("m", F.map_from_arrays("a", places)).withColumn("places", F.map_from_arrays(places, "a"))
    m, a = F.col("m"), F.col("a")
    pair = C.pairs(m)[0]
    second = F.when(F.size(a) >= 2, C.get_key(m, F.get(a, 1)))
    return w.select(
        "user_id", F.concat(pair["key"], F.lit("="), pair["value"].cast("string")).alias("first_pair"), F.size(C.pairs(m)).cast("bigint").alias("n_pairs"), F.array_join(F.transform(C.unpack(a, 2), lambda x: x["value"]), ",").alias("unpacked"), second.alias("second"),
        F.array_join(F.slice(a, F.lit(1), F.size(a) - 1), ",").alias("removed"), F.element_at(a, -1).alias("last"), F.array_join(a, "-").alias("joined"), C.next_key(m, a[0]).alias("after_first"), C.get_key(C.set_key(m, a[0], F.lit(99)), a[0]).alias("set_value"), C.max_key("places").cast("int").alias("max_key"),
    )


@query("""select o_orderkey, cast(epoch(o_orderdate) - epoch(timestamp '2020-01-01') as double) as difference, cast(epoch(date_trunc('day', o_orderdate)) + 43200 as bigint) as noon, strftime(o_orderdate, '%d/%m/%y %H:%M:%S %j %%') as written,
  day(o_orderdate) || ' ' || ['января', 'февраля', 'марта', 'апреля', 'мая', 'июня', 'июля', 'августа', 'сентября', 'октября', 'ноября', 'декабря'][month(o_orderdate)] || ' May' as localized, cast(date_trunc('day', o_orderdate) - interval 7 day as timestamp) as week_before from orders""")
def date_more(s, d):
    t = F.col("o_orderdate")
    months = "января февраля марта апреля мая июня июля августа сентября октября ноября декабря".split()
    return table(s, d, "orders").select(
        "o_orderkey", D.difference(t, F.lit("2020-01-01")).alias("difference"), D.os_time(F.year(t), F.month(t), F.dayofmonth(t)).alias("noon"), D.os_date(t, "%d/%m/%y %H:%M:%S %j %%").alias("written"), D.localized(t, 'j F "May"', months).alias("localized"),
        D.parse_date(F.lit("-1 week"), F.date_trunc("day", t)).alias("week_before"),
    )


# ---- titles, URLs, texts ------------------------------------------------------------


@query(f"""select id, ns, title, ns in (0, 10) as inside, ns = 0 as relevant, ns % 2 = 1 as talk, '/wiki/' || {_WIKI_URL} as local_url, '//w.example/wiki/' || {_WIKI_URL} as full_url, '//w.example/w/index.php?title=' || {_WIKI_URL} || '&a=b' as query_url, 'P:' || title || '#f' as made, title || '/sub' as sub,
  true as is_sub, 'wikitext' as model, 'image' as media, cast(null as varchar) as no_media, starts_with('http://' || title, 'http://') as protocol, not contains(title, ' ') as external from {_P}""")
def title_more(s, d):
    t = F.col("title")
    return _pages(s, d).select(
        "id", "ns", "title", T.in_namespace("ns", 0, 10).alias("inside"), T.relevant_namespace("ns").alias("relevant"), T.is_talk("ns").alias("talk"), U.title_url(t).alias("local_url"), U.title_url(t, "//w.example").alias("full_url"), U.title_url(t, "//w.example", F.lit("a=b")).alias("query_url"),
        T.make_title(F.lit("P"), t, F.lit("f")).alias("made"), T.transclusion_title(F.lit("/sub"), t, F.lit(True)).alias("sub"), T.is_subpage_of("ns", F.concat(t, F.lit("/x")), "ns", t).alias("is_sub"), T.content_model("ns", t).alias("model"), T.media_kind(F.concat(t, F.lit(".SVG")), True).alias("media"),
        T.media_kind(F.concat(t, F.lit(".svg"))).alias("no_media"), U.has_protocol(F.concat(F.lit("http://"), t)).alias("protocol"), U.is_external_url(F.concat(F.lit("http://x/"), t)).alias("external"),
    )


@query(f"""select id, title, title as decoded, title as twice, title as repaired, title || ' x' as unmarked, replace(title, ' ', '_') as anchor, 'rest ' || title as tail, cast(null as varchar) as no_tail, title || ' b' as stripped, title as basic, false as disabled, title = '' as blank, 'a ' || title || ' $2' as filled,
  upper(left(hex(title), 2)) as byte, strlen(title) > 0 as valid, title as composed from {_P}""")
def text_more(s, d):
    t = F.col("title")
    encoded = S.html_encode(t)
    return _pages(s, d).select(
        "id", "title", X.xml_decode_column(encoded).alias("decoded"), X.xml_decode_column(S.html_encode(encoded), True).alias("twice"), X.utf8_repaired_column(F.encode(t, "UTF-8")).alias("repaired"), S.kill_markers(F.concat(t, F.lit(" \x7f'\"`UNIQ-a-1-QINU`\"'\x7fx"))).alias("unmarked"),
        U.anchor_encode(t).alias("anchor"), T.redirect_tail(F.concat(F.lit("#REDIRECT [[x]] rest "), t)).alias("tail"), T.redirect_tail(F.concat(F.lit("[[x]] "), t)).alias("no_tail"), X.comments_stripped_column(F.concat(t, F.lit("<!-- a -->"), F.lit(" b"))).alias("stripped"), S.html_decode_basic(encoded).alias("basic"),
        S.is_disabled_message(t).alias("disabled"), S.is_blank_message(t).alias("blank"), S.fill_message(F.lit("a $1 $2"), t).alias("filled"), F.left(F.hex(F.encode(t, "UTF-8")), F.lit(2)).alias("byte"), S.is_utf8(F.encode(t, "UTF-8")).alias("valid"), X.normal_form_column(X.normal_form_column(t, "NFD"), "NFC").alias("composed"),
    )


_TAGS = "(select coalesce(lang, '') as lang, count(*) as n from documents group by 1)"


@query(f"""select lang, n, case when lang = '' then 'ltr' when lang in ('ar', 'he', 'fa', 'ur', 'yi') then 'rtl' else 'ltr' end as dir, case when lang in ('ar', 'he', 'fa', 'ur', 'yi') then '←' else '→' end as ahead, case when lang in ('ar', 'he', 'fa', 'ur', 'yi') then '→' else '←' end as back,
  regexp_full_match(lang, '[a-z]{{2,8}}(-[a-z0-9]{{1,8}})*') as tag, 'rtl' as script from {_TAGS}""")
def language_facts(s, d):
    rows = table(s, d, "documents").groupBy(F.coalesce("lang", F.lit("")).alias("lang")).agg(F.count("*").alias("n"))
    c = F.col("lang")
    return rows.select("lang", "n", S.direction(c).alias("dir"), S.arrow(F.lit("forwards"), c).alias("ahead"), S.arrow(F.lit("Backwards"), c).alias("back"), S.is_language_tag(c).alias("tag"), S.direction(F.concat(F.lit("az-arab"))).alias("script"))


@query(f"""select id, title, case when regexp_matches(title, '[{{}}\\[\\]<>|=]') then null else title end as az, case when regexp_matches(title, '[{{}}\\[\\]<>|=]') then null else title end as ar, cast(null as varchar) as en, 'fr' as dashes, 'en-x' as signs, cast(null as varchar) as none from {_P}""")
def language_declarations(s, d):
    t = F.col("title")
    around = lambda a, b: F.concat(F.lit(a), t, F.lit(b))
    return _pages(s, d).select(
        "id", "title", resolution.declared_language(around("{{Dil| ", " }}"), "az").alias("az"), resolution.declared_language(around("لغة ", ""), "ar").alias("ar"), resolution.declared_language(around("{{Dil|", "}}"), "en").alias("en"),
        resolution.marker_language(F.lit(" {{-fr-}}")).alias("dashes"), resolution.marker_language(F.lit("{{= en-x =}}")).alias("signs"), resolution.marker_language(around("{{-", " x-}}")).alias("none"),
    )


_REGISTRY = "(select distinct lang as code, 'L' || lang as name from documents where lang is not null)"


def _registry(s, d):
    codes = table(s, d, "documents").where("lang is not null").select(F.col("lang").alias("code")).distinct()
    return codes.select("code", F.lit("canonical").alias("kind"), F.concat(F.lit("L"), "code").alias("name"), F.lit(True).alias("trusted"))


@query("""with p as (select distinct doc_id, lang, doc_kind from documents), h as (select doc_id, lang, case when doc_id % 4 = 0 then 'l' || lang when doc_id % 4 = 1 then '[[:L' || lang || '|x]]' when doc_id % 4 = 2 then '[[L' || lang || '|Lqq]]' else '[[Len]] [[Lde]]' end as heading from p)
  select doc_id, heading, case when doc_id % 4 = 3 then null else lang end as code from h""")
def language_boundaries(s, d):
    """Headings that name their language as text, by a link, or not at all, as two links disagree."""
    kind, lang = F.col("doc_id") % 4, F.col("lang")
    heading = F.when(kind == 0, F.concat(F.lit("l"), lang)).when(kind == 1, F.concat(F.lit("[[:L"), lang, F.lit("|x]]"))).when(kind == 2, F.concat(F.lit("[[L"), lang, F.lit("|Lqq]]"))).otherwise("[[Len]] [[Lde]]")
    rows = table(s, d, "documents").select("doc_id", "lang").distinct().select("doc_id", heading.alias("heading"))
    return resolution.boundary_languages(rows, ["doc_id"], _registry(s, d))


@query("""select page_id, case when min(lang) = max(lang) then min(lang) end as code from documents where page_id is not null group by 1""")
def language_unsectioned(s, d):
    rows = table(s, d, "documents").where("page_id is not null").select("page_id", F.concat(F.lit("l"), "lang").alias("name"))
    return resolution.unsectioned_languages(rows, ["page_id"], _registry(s, d))


@query(f"select upper('L' || code) as name_key, code from {_REGISTRY}")
def language_strong(s, d):
    return resolution.strong_languages(_registry(s, d)).select(F.upper("name").alias("name_key"), "code")


# ---- joins by title and id ----------------------------------------------------------


@query("""with t as (select distinct title from bundle_pages where title is not null), p as (select title, id, deleted_at is not null as r, strlen(category_key) as l, category_key as c, row_number() over (partition by title order by id desc, deleted_at is not null desc, strlen(category_key) desc nulls last, category_key desc) as rn from pages)
  select t.title, p.id as page_id, p.id is not null as exists, coalesce(r, false) as is_redirect, cast(l as int) as length, c as content from t left join p on p.title = t.title and rn = 1""")
def title_contents(s, d):
    pages = table(s, d, "pages").select("title", F.col("id").alias("page_id"), F.col("deleted_at").cast("string").alias("redirect"), F.col("category_key").alias("source"))
    return resolution.contents(table(s, d, "bundle_pages").where("title is not null").select("title"), pages)


@query("""with a as (select distinct id as page_id, replace(title, '_', ' ') as xml_target from redirects where title is not null), b as (select distinct id as page_id, title as target from pages where title is not null)
  select a.page_id, xml_target, target, case when target is null then 'absent' when xml_target <> target then 'different' end as problem from a left join b using (page_id)""")
def redirects_bound(s, d):
    dump = table(s, d, "redirects").where("title is not null").select(F.col("id").alias("page_id"), F.translate("title", "_", " ").alias("xml_target"))
    return resolution.redirects_bound(dump, table(s, d, "pages").where("title is not null").select(F.col("id").alias("page_id"), F.col("title").alias("target")))


@query("""with l as (select title, min('Q' || id) as entity from targets where title is not null group by 1) select t.title, entity from (select distinct category_key as title from pages where category_key is not null) t left join l using (title)""")
def title_entities(s, d):
    links = table(s, d, "targets").select("title", F.concat(F.lit("Q"), F.col("id").cast("string")).alias("entity"))
    return resolution.entities_of(table(s, d, "pages").where("category_key is not null").select(F.col("category_key").alias("title")), links)


@query("""with e as (select distinct canonical_id as entity from wikibase where canonical_id is not null), k as (select distinct canonical_id as entity, entity_type as site, capture_id from wikibase), b as (select entity, 'T' || capture_id as title from k where site = 'lexeme')
  select e.entity, b.title from e left join b using (entity)""")
def entity_sitelinks(s, d):
    rows = table(s, d, "wikibase").where("canonical_id is not null").select(F.col("canonical_id").alias("entity"), F.col("entity_type").alias("site"), F.concat(F.lit("T"), F.col("capture_id").cast("string")).alias("title")).distinct()
    return resolution.sitelinks(rows.select("entity"), rows, "lexeme")


@query("""select distinct id, ns, title, ns = 0 or contains(title, ':') and instr(title, ':') < length(title) as valid from redirects where title is not null and title <> ''""")
def alias_validity(s, d):
    """Redirects as aliases of a main page: the key of a target in another namespace is behind its colon."""
    rows = table(s, d, "redirects").where("title is not null and title <> ''").select("id", "ns", "title").distinct()
    kind = F.when(F.col("ns") == 0, "language").otherwise("template")
    alias = {
        "source_kind": F.lit("language"), "source_namespace": F.lit(0), "source_title": F.lit("a"), "source_key": F.lit("a"), "target_kind": kind, "target_namespace": F.col("ns"),
        "target_title": F.col("title"), "target_key": F.when(kind == "language", F.col("title")).otherwise(F.expr("substring(title, instr(title, ':') + 1)")), "fragment": F.lit(""),
    }
    return rows.select("id", "ns", "title", T.is_valid_alias(alias).alias("valid"))


# ---- accounts -----------------------------------------------------------------------


@query("""with e as (select ns, count(distinct page_id) as expected from bundle_pages where coalesce(has_source, false) group by 1), f as (select ns, count(distinct id) as found from pages where deleted_at is null group by 1)
  select coalesce(e.ns, f.ns) as ns, coalesce(expected, 0) as expected, coalesce(found, 0) as found from e full join f on e.ns = f.ns where coalesce(expected, 0) <> coalesce(found, 0) and not (coalesce(e.ns, f.ns) = 0 and coalesce(found, 0) > coalesce(expected, 0))""")
def coverage_reconciled(s, d):
    """Namespaces whose live pages are not those with a source; of the main one more are allowed."""
    expected = table(s, d, "bundle_pages").where("has_source").groupBy("ns").agg(F.count_distinct("page_id").alias("expected"))
    found = table(s, d, "pages").where("deleted_at is null").groupBy("ns").agg(F.count_distinct("id").alias("found"))
    return A.reconciled(expected, found, ["ns"], F.col("ns") == 0)


@query("""with c as (select worker_slot as start, max(request_id) as "limit", count(*) as seen, (select count(*) from bundle_expander) as total from bundle_expander where worker_slot is not null group by 1),
  a as (select *, greatest(least(least("limit", total), total - start), 0) as asked from c) select start, "limit", seen, total, case when start > total then 'start behind the end' when seen < asked then 'pages missing' else 'pages too many' end as problem from a where start > total or seen <> asked""")
def page_coverage(s, d):
    rows = table(s, d, "bundle_expander")
    runs = rows.where("worker_slot is not null").groupBy(F.col("worker_slot").alias("start")).agg(F.max("request_id").alias("limit"), F.count("*").alias("seen"))
    return A.page_coverage_problems(runs.crossJoin(F.broadcast(rows.agg(F.count("*").alias("total")))))


@query("""with r as (select title from (select distinct id, title from targets) union all select title from (select distinct id, category_key as title from pages where category_key is not null)), i as (select distinct title from targets where title is not null union select 'Not there')
  select title, 'repeated' as problem from r group by 1 having count(*) > 1 union all select title, 'not captured' from i where title not in (select title from r where title is not null) union all select distinct title, 'not selected' from r where title is null or title not in (select title from i)""")
def capture_union(s, d):
    a = table(s, d, "targets").select("id", "title").distinct().select("title")
    b = table(s, d, "pages").where("category_key is not null").select("id", F.col("category_key").alias("title")).distinct().select("title")
    inventory = table(s, d, "targets").where("title is not null").select("title").union(s.createDataFrame([("Not there",)], "title string"))
    return A.strict_union([a, b], "title", inventory)[1]


@query("""with l as (select distinct src, dst from (select l.target as src, t.id as dst from (select distinct from_id, target from links where kind = 1 and target is not null) l join (select distinct id, category_key from pages where category_key is not null) p on p.id = l.from_id
    join (select distinct id, title from targets) t on t.title = p.category_key) where src <> dst),
  di as (select target as node, count(distinct from_id) as direct_reach from links where target is not null group by 1), pr as (select target as node, count(*) as page_reach from links where target is not null group by 1),
  lo as (select dst as node, sum(coalesce(page_reach, 0))::bigint as module_reach, count(*) as fan_in from l left join pr on pr.node = l.src group by 1), n as (select node from di union select src from l union select dst from l)
  select n.node, coalesce(page_reach, 0) as page_reach, coalesce(direct_reach, 0) as direct_reach, coalesce(module_reach, 0) as module_reach, coalesce(fan_in, 0) as fan_in from n left join pr using (node) left join di using (node) left join lo using (node)""")
def usage_profile(s, d):
    links = table(s, d, "links").where("target is not null")
    reach = links.groupBy(F.col("target").alias("node")).agg(F.count("*").alias("value"))
    return A.profile(links.select(F.col("from_id").alias("page"), F.col("target").alias("node")), _parents(s, d), reach)


@query("select page_id, source, count(*) as n_calls, count(*) - 1 as n_repeats from bundle_expander group by all")
def call_repeats(s, d):
    return A.repeats(table(s, d, "bundle_expander"), ["page_id", "source"])


@query("""select worker_slot, count(*) as n_pages, round(sum(duration_ms), 3) as duration_ms_sum, max(duration_ms) as duration_ms_max, count(duration_ms) as duration_ms_pages from bundle_expander group by 1""")
def work_statistics(s, d):
    return A.work_statistics(table(s, d, "bundle_expander"), ["worker_slot"], ["duration_ms"]).withColumn("duration_ms_sum", F.round("duration_ms_sum", 3))


@query("select 'link' as kind, target::varchar || chr(92) || 't' || coalesce(sortkey, '') as value, count(*) as n from links where target is not null group by all")
def usage_lines(s, d):
    from lexmill.sources.tsv import usage_edges

    rows = table(s, d, "links").where("target is not null").select(F.lit("link").alias("kind"), F.lit("x").alias("source"), F.concat(F.col("target").cast("string"), F.lit("\t"), F.coalesce("sortkey", F.lit(""))).alias("target"))
    lines = usage_edges(rows).select(F.lit("link").alias("kind"), F.substring("value", 8, 1 << 30).alias("value"))
    return lines.groupBy("kind", "value").agg(F.count("*").alias("n"))


# ---- graphs, batches, entities ------------------------------------------------------


@query(f"""with recursive t as (select ns, id, title, strlen(title) + 1 as size, row_number() over (partition by ns order by id, title) as rn from {_T} where title is not null),
  g as (select ns, id, title, rn, 0 as batch, 1 as n, size as total from t where rn = 1
    union all select t.ns, t.id, t.title, t.rn, case when g.n >= 50 or g.total + t.size > 1200 then g.batch + 1 else g.batch end, case when g.n >= 50 or g.total + t.size > 1200 then 1 else g.n + 1 end, case when g.n >= 50 or g.total + t.size > 1200 then t.size else g.total + t.size end
    from g join t on t.ns = g.ns and t.rn = g.rn + 1)
  select ns, id, title, batch from g""")
def title_batches(s, d):
    from lexmill.operators import sequences as Q

    return Q.batches(_titles(s, d), "ns", ["id", "title"], "title", 50, 1200)


@query("""with recursive m as (select p.title as src, min(replace(r.title, '_', ' ')) as dst from (select distinct id, title from redirects where coalesce(interwiki, '') = '' and title is not null) r join (select distinct id, title from pages) p using (id) where p.title is not null group by 1),
  f as (select title as start, title as node, 0 as hops from (select distinct title from pages) union all select f.start, m.dst, f.hops + 1 from f join m on m.src = f.node where f.hops <= 32),
  e as (select start, max(hops) as hops, max_by(node, hops) as node from f group by 1)
  select start, case when hops <= 32 then node end as node, case when hops <= 32 then hops end as hops, hops > 32 as loop from e""")
def redirects_followed(s, d):
    pages = _titles(s, d)
    moves = table(s, d, "redirects").where("coalesce(interwiki, '') = ''").join(pages.select("id", F.col("title").alias("src")), "id").select("src", F.translate("title", "_", " ").alias("dst"))
    return graphs.follow(moves, pages.select("title"))


@query(f"""with recursive {_EDGES}, r as (select src, dst from e union select r.src, e.dst from r join e on e.src = r.dst), u as (select target as node, count(*) as value from links where target is not null group by 1),
  n as (select src as node from e union select dst from e union select node from u), c as (select n.node, coalesce((select min(a.dst) from r a join r b on b.src = a.dst and b.dst = a.src where a.src = n.node), n.node) as component from n),
  l as (select distinct a.component as a, b.component as b from e join c a on a.node = e.src join c b on b.node = e.dst where a.component <> b.component),
  s as (select component, sum(coalesce(value, 0)) as value from c left join u using (node) group by 1), w as (select component, value from s union all select l.b, w.value from w join l on l.a = w.component where w.value > 0)
  select component, cast(sum(value) as bigint) as reach from w group by 1""")
def graph_reach(s, d):
    uses = table(s, d, "links").where("target is not null").groupBy(F.col("target").alias("node")).agg(F.count("*").alias("value"))
    return graphs.reach(_parents(s, d), uses)


@query(_NESTED + """, own as (select distinct capture_id, node_path, property, cast(position as int) as position, json_extract_string(x, '$.id') as claim_id, json_extract_string(x, '$.rank') as rank, json_extract_string(x, '$.type') as type from statements where parent_path = ''),
  r as (select *, case rank when 'preferred' then 2 when 'normal' then 1 end as r from own), b as (select *, max(r) over (partition by capture_id, property) as best from r) select capture_id, node_path, property, position, claim_id, rank, type from b where r = best""")
def entity_statements(s, d):
    return wikibase.statements(nested.captures(s, d)).drop("body")


@query("""with k as (select distinct canonical_id as x from wikibase where canonical_id is not null)
  select x, ' ' || lower(replace(x, 'L', 'l0')) as raw, x as canonical, 'https://e.example/' || case left(x, 1) when 'P' then 'Property:' when 'L' then 'Lexeme:' else '' end || x as url from k where regexp_full_match(x, '[QP][1-9][0-9]*|L[1-9][0-9]*(-[FS][1-9][0-9]*)?')""")
def entity_names(s, d):
    rows = table(s, d, "wikibase").where("canonical_id is not null").select(F.col("canonical_id").alias("x")).distinct().where(wikibase.is_valid_id("x"))
    raw = F.concat(F.lit(" "), F.lower(F.replace("x", F.lit("L"), F.lit("l0"))))
    return rows.select("x", raw.alias("raw"), wikibase.canonical_id(raw).alias("canonical"), wikibase.entity_url("x", "https://e.example/").alias("url"))


_KEYS = """with refs as (select distinct 'links' as src_table, 'target' as src_field, link_id as src_id, target as key, touched_at from links where target is not null union select 'redirects', 'id', id, id, touched_at from redirects where id is not null),
  k as (select 'links' as src_table, id as key, min(first_seen) filter (deleted_at is null) as since, bool_or(deleted_at is null) as live, bool_or(deleted_at is null and first_seen is null) as always from targets group by all
    union all select 'redirects', id, min(first_seen) filter (deleted_at is null), bool_or(deleted_at is null), bool_or(deleted_at is null and first_seen is null) from pages group by all),
  x as (select r.*, k.key is null as gone, live, since, always from refs r left join k on k.src_table = r.src_table and k.key = r.key)
  select distinct src_table, src_field, src_id, case when gone then 'missing' when not live then 'deleted' else 'late' end as reason, strftime(touched_at, '%Y-%m') as period from x where gone or not live or (since > touched_at and not always)"""


@query(_KEYS)
def orphan_ids(s, d):
    """Orphan references of the two integer relations: links.target and redirects.id."""
    refs, parents = orphans.relations(s, d)
    return orphans.orphan_references(refs.where("rel <> 'redirects.title'"), parents.where("rel <> 'redirects.title'"))
