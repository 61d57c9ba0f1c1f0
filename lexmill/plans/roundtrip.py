"""Sources and sinks over the test tables: what is written in a format is read back, with the SQL of what must come out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.lazy import mapped
from lexmill.operators import reader, resolution
from lexmill.plans.core import _lower, query
from lexmill.session import shared_dir, table
from lexmill.sources import mysqldump, siteinfo, sinks, snapshots, tsv, xml


def _written(spark: SparkSession, lines: DataFrame) -> str:
    """A folder of the lines (value) as text, in the folder all executors share."""
    path = f"{shared_dir(spark)}/lexmill-{uuid.uuid4().hex}"
    lines.select("value").write.text(path)
    return path


def _xml_written(spark: SparkSession, rows: DataFrame, row_tag: str) -> str:
    path = f"{shared_dir(spark)}/lexmill-{uuid.uuid4().hex}"
    rows.write.format("xml").option("rowTag", row_tag).option("rootTag", "mediawiki").save(path)
    return path


@query("""select title, ns, id as page_id, category_key as redirect, id + 7 as revision_id, '2020-01-01T00:00:00Z' as revision_timestamp, case when id % 2 = 0 then 'u' || id else '10.0.0.1' end as revision_user, 'wikitext' as content_model, cast(null as varchar) as content_format, '<b>' || title || '</b> & more' as source
  from (select distinct id, ns, title, category_key from pages where title is not null)""")
def xml_pages(s, d):
    """Every page as XML of a dump, read back."""
    rows = table(s, d, "pages").where("title is not null").select("id", "ns", "title", "category_key").distinct()
    even = F.col("id") % 2 == 0
    who = F.struct(F.when(even, F.concat(F.lit("u"), F.col("id").cast("string"))).alias("username"), F.when(~even, "10.0.0.1").alias("ip"))
    text = F.concat(F.lit("<b>"), "title", F.lit("</b> & more"))
    revision = F.struct((F.col("id") + 7).alias("id"), F.lit("2020-01-01T00:00:00Z").alias("timestamp"), who.alias("contributor"), F.lit("wikitext").alias("model"), text.alias("text"))
    move = F.when(F.col("category_key").isNotNull(), F.struct(F.col("category_key").alias("_title")))
    return xml.pages(s, _xml_written(s, rows.select("title", "ns", "id", move.alias("redirect"), revision.alias("revision")), "page"))


@query("select id, lower(name) as case_policy, name from (select distinct id, name from namespace_registry)")
def xml_namespaces(s, d):
    rows = table(s, d, "namespace_registry").select("id", "name").distinct()
    named = rows.select(F.col("id").alias("_key"), F.lower("name").alias("_case"), F.col("name").alias("_VALUE"))
    found = xml.namespaces(s, _xml_written(s, named, "namespace"))
    return found.withColumn("case_policy", F.coalesce("case_policy", F.lit("")))


@query("""select cast(id as bigint) as "offset", cast(strlen(title) as bigint) as length, title, category_key as redirect, id as page_id, id + 7 as revision_id, 't' as revision_timestamp, 'u' as revision_user, cast(null as varchar) as content_model, ns, deleted_at is null as has_source, false as needs_decode
  from (select distinct id, ns, title, category_key, deleted_at from pages where title is not null)""")
def tsv_index(s, d):
    """Every page as a line of a page index, read back."""
    rows = table(s, d, "pages").where("title is not null").select("id", "ns", "title", "category_key", "deleted_at").distinct()
    nil = F.lit("\\N")
    cells = [F.col("id"), F.octet_length("title"), F.col("title"), F.coalesce("category_key", nil), F.col("id"), F.col("id") + 7, F.lit("t"), F.lit("u"), nil, F.col("ns"), F.col("deleted_at").isNull(), F.lit(False)]
    return tsv.read(s, _written(s, rows.select(F.concat_ws("\t", *[c.cast("string") for c in cells]).alias("value"))), "page_index_raw")


@query("""select id as page_id, min(ns) as ns, min(coalesce(title, '')) as title, min(coalesce(interwiki, '')) as interwiki, min(coalesce(fragment, '')) as fragment from redirects group by 1 having count(distinct (ns, title, interwiki, fragment)) = 1""")
def tsv_redirects(s, d):
    """The redirect table in hexadecimal lines, read back; pages with several redirects have none."""
    rows = table(s, d, "redirects").select(F.col("id").alias("rd_from"), F.col("ns").alias("rd_namespace"), F.col("title").alias("rd_title"), F.col("interwiki").alias("rd_interwiki"), F.col("fragment").alias("rd_fragment")).distinct()
    single = rows.groupBy("rd_from").agg(F.count("*").alias("n")).where("n = 1").select("rd_from")
    kept = snapshots.redirect_rows(rows.join(single, "rd_from", "left_semi"))
    return tsv.redirects(s, _written(s, kept.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in kept.columns]).alias("value"))))


@query("""select distinct id, name, canonical_name, case_policy, has_subpages, is_content, is_includable, coalesce(content_model, '') as content_model, ns_role, 'r' as reason, 'a' || id || '|b' as aliases from namespace_registry""")
def tsv_registry(s, d):
    rows = table(s, d, "namespace_registry").distinct()
    names = ["id", "name", "canonical_name", "case_policy", "has_subpages", "is_content", "is_includable", "content_model", "ns_role"]
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names] + [F.lit("r"), F.concat(F.lit("a"), F.col("id").cast("string")), F.lit("b"), F.lit("")]
    return tsv.registry(s, _written(s, rows.select(F.concat_ws("\t", *cells).alias("value")))).withColumn("aliases", F.array_join("aliases", "|"))


@query("""select id, title, '1' as first, 'it''s ' || title as second, cast(null as varchar) as third, 2 as n_rows from (select distinct id, title from pages where title is not null)""")
def sql_literals(s, d):
    """Row literals of a database dump: quoted text with escapes, numbers and NULL."""
    t = F.replace(F.replace(F.col("title"), F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    text = F.concat(F.lit("(1,'it\\'s "), t, F.lit("',NULL),(2,'x',3.5);"))
    rows = table(s, d, "pages").where("title is not null").select("id", "title").distinct()
    read = mapped(lambda x: [[None if v is None else str(v) for v in row] for row in mysqldump.tuples(x, 3)], "array<array<string>>", text)
    rows = rows.select("id", "title", read.alias("r"))
    return rows.select("id", "title", F.col("r")[0][0].alias("first"), F.col("r")[0][1].alias("second"), F.col("r")[0][2].alias("third"), F.size("r").alias("n_rows"))


# ---- snapshots ----------------------------------------------------------------------


@query("select distinct replace(title, '_', ' ') as title, 'Q' || id as item from targets where title is not null")
def snapshot_links(s, d):
    page = table(s, d, "targets").where("title is not null").select(F.col("id").alias("page_id"), F.col("title").alias("page_title")).distinct()
    props = page.select(F.col("page_id").alias("pp_page"), F.lit("wikibase_item").alias("pp_propname"), F.concat(F.lit("Q"), F.col("page_id").cast("string")).alias("pp_value"))
    return snapshots.page_links(page, props.unionByName(props.withColumn("pp_propname", F.lit("other"))))


@query("""with c as (select distinct lang as code from documents where lang is not null)
  select 'canonical' as kind, code, 'L' || code as name from c union all select 'alias', code, 'Old ' || code from c union all select 'code', code, code from c""")
def snapshot_languages(s, d):
    site = table(s, d, "documents").where("lang is not null").select(F.col("lang").alias("code")).distinct().withColumn("name", F.concat(F.lit("L"), "code"))
    iso = site.unionByName(site.select("code", F.concat(F.lit("Old "), "code").alias("name"))).unionByName(s.createDataFrame([("zzz", "Unknown")], "code string, name string"))
    return snapshots.language_registry(site, iso)


@query("""select distinct title || '.png' as file, case id % 3 when 0 then 'missing' when 1 then 'redirect' else 'present' end as state, case when id % 3 = 2 then id::int end as width, case when id % 3 = 2 then 7 end as height, case when id % 3 = 2 then 'image/png' end as mime from pages where title is not null""")
def snapshot_files(s, d):
    rows = table(s, d, "pages").where("title is not null").select("id", "title").distinct()
    present = F.concat(F.lit('{"imageinfo":[{"width":'), F.col("id").cast("string"), F.lit(',"height":7,"mime":"image/png"}]}'))
    document = F.when(F.col("id") % 3 == 0, '{"missing":true}').when(F.col("id") % 3 == 1, '{"redirect":"x"}').otherwise(present)
    return snapshots.file_rows(rows.select(F.concat("title", F.lit(".png")).alias("file"), document.alias("document"))).distinct()


@query("""select 'en' as language, 'm' || id as message, 'V' as state, title as text from (select distinct id, title from pages where title is not null) union all select 'en', 'n' || id, 'M', '' from (select distinct id, title from pages where title is not null)""")
def snapshot_messages(s, d):
    rows = table(s, d, "pages").where("title is not null").select("id", "title").distinct()
    one = F.to_json(F.array(F.struct(F.concat(F.lit("m"), F.col("id").cast("string")).alias("name"), F.col("title").alias("content"), F.lit(None).cast("string").alias("missing")), F.struct(F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"), F.lit(None).cast("string").alias("content"), F.lit("").alias("missing"))))
    return snapshots.message_rows(rows.select(F.lit("en").alias("language"), one.alias("document")))


@query("""with p as (select distinct id, title from pages where title is not null) select 'd' || id as name, 0 as row, 'n' as "column", cast(id as varchar) as value from p union all select 'd' || id, 0, 't', title from p""")
def snapshot_tables(s, d):
    rows = table(s, d, "pages").where("title is not null").select("id", "title").distinct()
    text = F.to_json(F.struct(F.col("title").alias("fr")))
    document = F.concat(F.lit('{"schema":{"fields":[{"name":"n","type":"number"},{"name":"t","type":"localized"}]},"data":[['), F.col("id").cast("string"), F.lit(","), text, F.lit("]]}"))
    return snapshots.tabular_data(rows.select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("name"), document.alias("document")), ["en", "fr"])


@query("""select user_id as wiki, max(day) as date from (select user_id, cast(ts as date) as day, bool_and(value >= 20) as done, count(distinct event_type) as n from events where event_type in ('view', 'click') group by all) where done and n = 2 group by 1""")
def dump_dates(s, d):
    """The newest day on which both jobs of each wiki are done, with events for jobs."""
    status = table(s, d, "events").select(F.col("user_id").alias("wiki"), F.to_date("ts").alias("date"), F.col("event_type").alias("job"), (F.col("value") >= 20).alias("done"))
    return siteinfo.complete_dates(status, ["view", "click"])


@query("""with c as (select distinct lang as language from documents where lang is not null), a as (select language, m from c, (values ('m1'), ('m2')) v(m))
  select language, m as message, case when m = 'm2' then null when language = 'de' then 'Hallo' when language in ('en') then 'Hello' else 'Hello' end as text, case when m = 'm2' then null when language = 'de' then 'de' else 'en' end as source from a""")
def messages_by_fallback(s, d):
    codes = table(s, d, "documents").where("lang is not null").select(F.col("lang").alias("language")).distinct()
    asked = codes.select("language", F.explode(F.array(F.lit("m1"), F.lit("m2"))).alias("message"))
    known = s.createDataFrame([("de", "m1", "V", "Hallo"), ("en", "m1", "V", "Hello"), ("en", "m2", "M", "")], "language string, message string, state string, text string")
    chains = codes.select(F.col("language").alias("code"), F.array(F.lit("xx"), F.lit("en")).alias("chain"))
    return resolution.messages(asked, known, chains)


# ---- dictionaries -------------------------------------------------------------------


def _entries(s, d):
    rows = table(s, d, "documents").where("lang is not null and page_id is not null").select("lang", "page_id").distinct()
    return rows.select(F.lit("language").alias("kind"), F.col("lang").alias("language"), F.concat(F.lit("Title "), F.col("page_id").cast("string")).alias("title"), F.col("page_id").alias("payload"))


def _dictionary(s, d) -> reader.Dictionary:
    path = f"{shared_dir(s)}/lexmill-{uuid.uuid4().hex}"
    sinks.write_dictionary(_entries(s, d), path)
    return reader.Dictionary.open(s, path)


_ROWS = "(select distinct 'language' as kind, lang as language, 'Title ' || page_id as title, page_id as payload from documents where lang is not null and page_id is not null)"


@query(f"select language, count(*) as n_records from {_ROWS} group by 1")
def dictionary_languages(s, d):
    return _dictionary(s, d).languages()


@query(f"select kind, count(*) as n_records, count(distinct language) as n_languages from {_ROWS} group by 1")
def dictionary_stats(s, d):
    return _dictionary(s, d).stats()


@query(f"""with h as (select title, payload, language from {_ROWS} where language = 'en' and starts_with({_lower('title')}, 'title 1'))
  select title, payload, (select count(*) from h) as total, 10 < (select count(*) from h) as has_more from (select * from h order by {_lower('title')}, title limit 10)""")
def dictionary_search(s, d):
    return _dictionary(s, d).select("en").search_folded("TITLE 1", 10).select("title", "payload", "total", "has_more")


@query(f"select language, title, payload from {_ROWS} where title = (select max(title) from {_ROWS} t)")
def dictionary_lookup(s, d):
    wanted = _entries(s, d).agg(F.max("title")).first()[0]
    return _dictionary(s, d).lookup(wanted).select("language", "title", "payload")


@query(f"select language as heading, sha256(language) || '.wikblb' as file, count(*) as n_records from {_ROWS} group by all")
def dictionary_manifest(s, d):
    return sinks.manifest(_entries(s, d))


@query(f"""select '{{"schema":"results.v1","query":"q","title":"' || title || '","payload":' || payload || '}}' as json from {_ROWS}""")
def dictionary_json(s, d):
    return sinks.json_response(_entries(s, d), "q", ["title", "payload"])


@query("""select page_id as ns, title, array_to_string(list_sort(list_distinct(r)), ',') as reasons from (select page_id, title, list(outcome order by outcome) filter (outcome <> 'expanded') as r from bundle_expander group by all) where len(r) > 0""")
def fallback_lines(s, d):
    rows = table(s, d, "bundle_expander").groupBy(F.col("page_id").alias("ns"), "title").agg(F.sort_array(F.collect_list(F.when(F.col("outcome") != "expanded", F.col("outcome")))).alias("reasons"))
    return sinks.fallback_report(rows).withColumn("reasons", F.array_join(F.sort_array("reasons"), ","))
