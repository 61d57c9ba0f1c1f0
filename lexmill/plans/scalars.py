"""Scalar functions of the reference applied to whole columns, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.functions import collections as C
from lexmill.functions import dates as D
from lexmill.functions import expression, patterns, plurals
from lexmill.functions import numbers as N
from lexmill.functions import strings as S
from lexmill.functions import texts as X
from lexmill.functions import titles as T
from lexmill.functions import uris as U
from lexmill.operators import nested, snapshots, wikibase
from lexmill.plans.core import query
from lexmill.plans.pipeline import _LEMMAS
from lexmill.session import table


def _pages(s, d):
    return table(s, d, "pages").where("title is not null").select("id", "ns", "title").distinct()


_P = "(select distinct id, ns, title from pages where title is not null)"


@query(f"""select id, title, cast(strlen(title) as int) as n_bytes, cast(length(title) as int) as n_chars, translate(title, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low,
  translate(title, 'abcdefghijklmnopqrstuvwxyz', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ') as high, repeat(title, 2) as twice, title || '-' || title || '-' || title as thrice,
  substring(title, 2, greatest(length(title) - 2, 0)) as middle, right(title, 3) as tail, cast(nullif(instr(title, 'a'), 0) as int) as at,
  case when length(title) >= 3 then cast(strlen(left(title, 2)) + 1 as int) end as third_byte, cast(ord(title) as int) as first_code from {_P}""")
def string_basics(s, d):
    t = F.col("title")
    return _pages(s, d).select(
        "id", "title", S.byte_len(t).alias("n_bytes"), S.ulen(t).alias("n_chars"), S.byte_lower(t).alias("low"), S.byte_upper(t).alias("high"), S.rep(t, 2).alias("twice"), S.rep(t, 3, "-").alias("thrice"),
        S.usub(t, 2, -2).alias("middle"), S.usub(t, -3).alias("tail"), S.find_plain(t, "a")["first"].alias("at"), S.byte_offset(t, 3).alias("third_byte"), S.codepoints(t)[0].alias("first_code"),
    )


@query(f"""select id, title, upper(left(title, 1)) || substring(title, 2) as up_first, lower(left(title, 1)) || substring(title, 2) as low_first, hex(title) as bytes, md5(title) as hash,
  case when contains(title, ' ') then string_split(title, ' ')[1] else title end as word, len(string_split(title, ' ')) as n_words, trim(title, 'aeiou') as trimmed, title as again
  from {_P}""")
def string_more(s, d):
    rows, t = _pages(s, d), F.col("title")
    words = S.split_plain(t, " ")
    return rows.select("id", "title", S.first_upper(t).alias("up_first"), S.first_lower(t).alias("low_first"), F.hex(F.encode(t, "UTF-8")).alias("bytes"), F.md5(t).alias("hash"), words[0].alias("word"), F.size(words).cast("bigint").alias("n_words"), S.trim(t, "aeiou").alias("trimmed"), S.from_codepoints(S.codepoints(t)).alias("again"))


_ENCODED = """replace(replace(replace(replace(replace(replace(title, '&', '&amp;'), '>', '&gt;'), '<', '&lt;'), '"', '&quot;'), '''', '&#39;'), chr(160), '&nbsp;')"""


@query(f"""select id, title, case when length(title) > 5 and length(left(title, 5) || '…') < length(title) then left(title, 5) || '…' else title end as cut,
  case when length(title) < 12 then lpad(title, 12, '*') else title end as padded_left, case when length(title) < 12 then rpad(title, 12, 'ab') else title end as padded_right,
  {_ENCODED} as encoded, '<b id="' || {_ENCODED} || '" x>' || title || '</b>' as tagged from {_P}""")
def string_layout(s, d):
    t = F.col("title")
    return _pages(s, d).select("id", "title", S.truncate(t, 5).alias("cut"), S.pad(t, 12, "*").alias("padded_left"), S.pad(t, 12, "ab", left=False).alias("padded_right"), S.html_encode(t).alias("encoded"), S.tag("b", [("id", t), ("x", True), ("y", False)], t).alias("tagged"))


@query("""with w as (select user_id, list(distinct event_type order by event_type) as a from events group by 1)
  select user_id, case len(a) when 0 then '' when 1 then a[1] else array_to_string(a[:len(a)-1], ', ') || ' and ' || a[len(a)] end as listed, array_to_string(a[2:], '|') as rest, len(a) as n,
  array_to_string(list_concat(a, ['new']), ',') as added, array_to_string(list_reverse(a), ',') as reversed from w""")
def list_functions(s, d):
    w = table(s, d, "events").groupBy("user_id").agg(F.sort_array(F.collect_set("event_type")).alias("a"))
    return w.select("user_id", S.list_to_text(F.col("a")).alias("listed"), F.array_join(C.select("a", 2), "|").alias("rest"), C.length("a").cast("bigint").alias("n"), F.array_join(C.insert("a", F.lit("new")), ",").alias("added"), F.array_join(C.sort("a", True), ",").alias("reversed"))


@query(f"""select id, title, nullif(regexp_extract(title, '^([A-Za-z]+)', 1), '') as lead, regexp_replace(title, '[aeiou]', '<>', 'g') as marked, len(regexp_extract_all(title, '[A-Za-z]+')) as n_words,
  regexp_replace(title, '([a-z])([a-z])', '\\2\\1', 'g') as swapped from {_P}""")
def lua_patterns(s, d):
    t = F.col("title")
    return _pages(s, d).select("id", "title", patterns.match_column(t, "^(%a+)", unicode=False).alias("lead"), patterns.gsub_column(t, "[aeiou]", "<>").alias("marked"), F.size(patterns.gmatch_column(t, "%a+", unicode=False)).cast("bigint").alias("n_words"), patterns.gsub_column(t, "(%l)(%l)", "%2%1", unicode=False).alias("swapped"))


@query()
def lua_patterns_python(s, d):
    t = F.col("title")
    return _pages(s, d).select("id", patterns.find_column(t, "%s()%w", 2).alias("at"), patterns.gsub_column(t, "%w", "%0%0", 1).alias("once"), patterns.match_column(t, "%b()").alias("pair"))


def _url(x: str, keep: str, space: str) -> str:
    """SQL of x with all but letters, digits, ``-._`` and keep as percent codes."""
    out = f"replace(url_encode({x}), '%20', '{space}')"
    for char in "*~":
        out = f"replace({out}, '{char}', '%{ord(char):02X}')"
    for char in keep:
        out = f"replace({out}, '%{ord(char):02X}', '{char}')"
    return out


_WIKI_URL = _url("replace(title, ' ', '_')", ";@$!*(),/~:", "_")


@query(f"select id, title, {_url('title', '~', '+')} as q, {_WIKI_URL} as w, title as back from {_P}")
def url_functions(s, d):
    t = F.col("title")
    return _pages(s, d).select("id", "title", U.encode(t).alias("q"), U.encode(t, "WIKI").alias("w"), U.decode(U.encode(t, "PATH"), "PATH").alias("back"))


@query(f"""with u as (select id, 'https://w.example:8080/wiki/' || {_WIKI_URL} || '?a=' || id || '&b=1&a=2#top' as url from {_P})
  select id, 'https' as protocol, 'w.example' as host, 8080 as port, regexp_extract(url, '8080([^?]*)', 1) as path, regexp_extract(url, '[?]([^#]*)', 1) as query, 'top' as fragment, url as whole, id || ',2' as a_values, true as valid from u""")
def url_parts(s, d):
    """Titles stand in the path as wiki URLs write them, so ? and # of a title end no part."""
    url = F.concat(F.lit("https://w.example:8080/wiki/"), U.encode("title", "WIKI"), F.lit("?a="), F.col("id").cast("string"), F.lit("&b=1&a=2#top"))
    rows = _pages(s, d).select("id", U.parts(url).alias("p"))
    return rows.select("id", "p.protocol", "p.host", "p.port", "p.path", "p.query", "p.fragment", U.to_text(F.col("p")).alias("whole"), F.array_join(U.query_map("p.query")["a"], ",").alias("a_values"), U.is_valid(F.col("p")).alias("valid"))


@query("""select distinct o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as iso, cast(day(o_orderdate) as varchar) || ' ' || monthname(o_orderdate) || ' ' || year(o_orderdate) as dmy, strftime(o_orderdate, '%Y%m%d%H%M%S') as compact,
  cast(weekofyear(o_orderdate) as int) as week, cast(dayofweek(o_orderdate) as int) as weekday, cast(dayofyear(o_orderdate) as int) as year_day, left(dayname(o_orderdate), 3) || ' ' || left(monthname(o_orderdate), 3) as short,
  cast(epoch(o_orderdate) as bigint) as unix, cast(weekofyear(make_date(year(o_orderdate), 12, 28)) as int) as weeks, lpad(cast((hour(o_orderdate) + 11) % 12 + 1 as varchar), 2, '0') || case when hour(o_orderdate) < 12 then 'am' else 'pm' end as clock from orders""")
def date_formats(s, d):
    t = F.col("o_orderdate")
    return table(s, d, "orders").select(
        "o_orderkey", D.format_date(t, "Y-m-d").alias("iso"), D.format_date(t, "j F Y").alias("dmy"), D.compact(t).alias("compact"), D.iso_week(t).alias("week"), D.weekday(t).alias("weekday"), D.year_day(t).alias("year_day"),
        D.format_date(t, "D M").alias("short"), D.unix(t).alias("unix"), D.iso_weeks_in_year(F.year(t)).alias("weeks"), D.format_date(t, "ha").alias("clock"),
    ).distinct()


@query("""with t as (select o_orderkey, o_orderdate, cast(day(o_orderdate) as varchar) as d, cast(month(o_orderdate) as varchar) as m, cast(year(o_orderdate) as varchar) as y from orders)
  select o_orderkey, date_trunc('day', o_orderdate) as a, date_trunc('day', o_orderdate) as b, date_trunc('day', o_orderdate) as c, date_trunc('month', o_orderdate) as e, date_trunc('month', o_orderdate) + interval 1 month as f,
  '<span class="mw-formatted-date" title="' || strftime(o_orderdate, '%Y-%m-%d') || '">' || monthname(o_orderdate) || ' ' || d || ', ' || y || '</span>' as span from t""")
def date_parsing(s, d):
    t = F.col("o_orderdate")
    day, month, year = (f(t).cast("string") for f in (F.dayofmonth, F.month, F.year))
    slash = F.concat(month, F.lit("/"), day, F.lit("/"), year)
    dots = F.concat(day, F.lit("."), month, F.lit("."), year)
    words = D.format_date(t, "j F Y")
    return table(s, d, "orders").select(
        "o_orderkey", D.parse_date(slash, t).alias("a"), D.parse_date(dots, t).alias("b"), D.parse_date(words, t).alias("c"), D.parse_date(D.format_date(t, "F Y"), t).alias("e"),
        D.parse_date(F.lit("first day of next month"), t).alias("f"), D.format_preference(words, "mdy", t).alias("span"),
    )


@query("""select l_orderkey, l_linenumber, cast(l_quantity as bigint) % 7 as m, greatest(l_quantity, l_discount) as hi, least(l_quantity, l_tax) as lo, cast(l_partkey & 255 as bigint) as band, cast((l_partkey | 256) & 4294967295 as bigint) as bor,
  trunc(l_extendedprice) as whole, cast(floor(abs(l_extendedprice)) as bigint) as floored, round(degrees(radians(l_quantity)), 6) as deg from lineitem""")
def number_functions(s, d):
    q = F.col("l_quantity")
    return table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", N.expr_mod(q, F.lit(7.0)).alias("m"), N.maximum(q, "l_discount").alias("hi"), N.minimum(q, "l_tax").alias("lo"), N.bit_and("l_partkey", F.lit(255)).alias("band"), N.bit_or("l_partkey", F.lit(256)).alias("bor"),
        N.modf("l_extendedprice")["whole"].alias("whole"), N.ONE["floor"](N.ONE["abs"](F.col("l_extendedprice"))).cast("bigint").alias("floored"), F.round(N.ONE["deg"](N.ONE["rad"](q)), 6).alias("deg"),
    )


@query("""select o_orderkey, case when o_orderkey < 1000 then cast(o_orderkey as varchar) else regexp_replace(format('{:,}', o_orderkey), 'x', 'x') end as grouped, cast(o_orderkey as double) as parsed, cast(o_orderkey as varchar) as shown,
  cast(o_orderkey as double) as hexed, true as same, case when o_orderkey = 1 then 'one' else 'many' end as form, o_orderkey % 2 = 0 as truth, cast(o_orderkey * 2 + 1 as varchar) as value from orders""")
def number_texts(s, d):
    k = F.col("o_orderkey").cast("string")
    rows = table(s, d, "orders")
    grouped = S.format_number(k)
    return rows.select(
        "o_orderkey", grouped.alias("grouped"), S.parse_number(grouped).alias("parsed"), N.to_text("o_orderkey").alias("shown"), N.to_number(F.lower(F.hex("o_orderkey")), 16).alias("hexed"), N.same_number(k, F.concat(k, F.lit(".0"))).alias("same"),
        plurals.plural_column(k, ["one", "many"]).alias("form"), expression.truth_column(F.concat(k, F.lit(" mod 2 = 0"))).alias("truth"), expression.expr_column(F.concat(k, F.lit(" * 2 + 1"))).alias("value"),
    )


@query("""select o_orderkey, case o_orderkey % 10 when 1 then case o_orderkey % 100 when 11 then 2 else 0 end when 2 then case o_orderkey % 100 when 12 then 2 else 1 end when 3 then case o_orderkey % 100 when 13 then 2 else 1 end
  when 4 then case o_orderkey % 100 when 14 then 2 else 1 end else 2 end as ru, case when o_orderkey = 1 then 0 else 1 end as en from orders""")
def plural_forms(s, d):
    k = F.col("o_orderkey").cast("string")
    return table(s, d, "orders").select("o_orderkey", plurals.form_index_column(k, "ru").alias("ru"), plurals.form_index_column(k, "en").alias("en"))


@query("""select event_id, cast(json_extract_string(props, '$.k') as varchar) as k, json_extract_string(props, '$.k') is not null as has_k from events""")
def json_access(s, d):
    v = C.json_decode(F.regexp_replace("props", r"\}\s*$", ",}"), repair=True)
    k = F.try_variant_get(v, "$.k", "string")
    return table(s, d, "events").select("event_id", k.alias("k"), k.isNotNull().alias("has_k"))


@query(f"""select id, ns, title, case when ns = 0 then title else case when contains(title, ':') then substring(title, instr(title, ':') + 1) else title end end as key,
  case when contains(title, ':') and not ends_with(title, ':') then substring(title, instr(title, ':') + 1) else title end as local,
  string_split(title, '/')[1] as root, string_split(title, '/')[-1] as sub, len(title) <= 255 and not contains(title, '#') as valid,
  case when title < lead then -1 when title > lead then 1 else 0 end as cmp from (select *, min(title) over () as lead from {_P})""")
def title_functions(s, d):
    t = F.col("title")
    rows = _pages(s, d)
    lead = rows.agg(F.min("title")).scalar()
    kind = F.when(F.col("ns") == 0, "language").otherwise("template")
    return rows.withColumn("lead", lead).select("id", "ns", "title", T.lookup_key(t, kind).alias("key"), T.local_title(t).alias("local"), T.root_page(t).alias("root"), T.sub_page(t).alias("sub"), T.is_valid(t).alias("valid"), T.compare((t,), (F.col("lead"),)).alias("cmp"))


_SPACED = r"trim(regexp_replace(regexp_replace(title, '[\x{200e}\x{200f}\x{202a}-\x{202e}]', '', 'g'), '[ _\x{a0}\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'), ' ')"


@query(f"""select id, ns, title, {_SPACED} as spaced, trim(regexp_replace(split_part(title, '#', 1), '[ _]+', '_', 'g'), '_') as dbkey from (select distinct id, ns, title from redirects)""")
def title_keys(s, d):
    """A null title keeps its row and has no keys."""
    return table(s, d, "redirects").select("id", "ns", "title").distinct().select("id", "ns", "title", S.normalize_space("title").alias("spaced"), S.category_key("title").alias("dbkey"))


@query(f"select id, title, ns as ns_id, title as normal from {_P}")
def title_normal(s, d):
    names = T.registry_names(table(s, d, "namespace_registry"))
    n = T.normalized_column(F.concat(F.lit(" "), F.translate("title", " ", "_")), names)
    return _pages(s, d).select("id", "title", n.alias("n")).select("id", "title", F.col("n.ns").alias("ns_id"), F.col("n.title").alias("normal"))


INSTANT = """(cast(replace(substr(revision_timestamp, 1, 19), 'T', ' ') as timestamp)
  - case when substr(revision_timestamp, 20, 1) in ('+', '-') then (case substr(revision_timestamp, 20, 1) when '+' then 1 else -1 end)
    * (cast(substr(revision_timestamp, 21, 2) as int) * interval 1 hour + cast(substr(revision_timestamp, 24, 2) as int) * interval 1 minute) else interval 0 hour end)"""


@query(f"""select revision_id, revision_timestamp as ts, strftime({INSTANT}, '%Y%m%d%H%M%S') as compact, strftime({INSTANT}, '%Y') as year, cast(month({INSTANT}) as varchar) as month1
  from (select distinct revision_id, revision_timestamp from bundle_pages)""")
def revision_words(s, d):
    """Timestamps in every form, as instants in UTC; unreadable ones give null words."""
    rows = table(s, d, "bundle_pages").select("revision_id", "revision_timestamp").distinct()
    t = snapshots.instant("revision_timestamp")
    return rows.select("revision_id", F.col("revision_timestamp").alias("ts"), D.compact(t).alias("compact"), D.format_date(t, "Y").alias("year"), D.format_date(t, "n").alias("month1"))


@query("""with x as (select distinct revision_id, source, regexp_replace(source, '<nowiki\\b[^>]*>.*?</nowiki\\s*>|<!--.*?-->', '', 'gis') as bare from bundle_pages where source is not null)
  select revision_id, contains(bare, '{{') or contains(bare, '}}') or contains(bare, chr(127)) as unresolved, regexp_matches(source, 'Lua error|Expression error|class="[^"]*\\berror\\b') as failed,
  regexp_matches(source, '\\[\\[|\\]\\]|\\{\\{|\\}\\}|\\{\\||\\|\\}|</?[A-Za-z][^<>]*>') as markup, regexp_matches(source, '__[A-Z]{3,}__') as switch from x""")
def markup_diagnostics(s, d):
    rows = table(s, d, "bundle_pages").where("source is not null").select("revision_id", "source").distinct()
    kinds = T.diagnostics("source")
    return rows.select("revision_id", T.unresolved_syntax("source").alias("unresolved"), T.has_error("source").alias("failed"), F.array_contains(kinds, "source-markup").alias("markup"), F.array_contains(kinds, "behavior-switch").alias("switch"))


@query()
def wikitext_links(s, d):
    rows = table(s, d, "bundle_pages").where("source is not null").select("revision_id", "source").distinct()
    return rows.select("revision_id", X.links_column("source").alias("links"), X.external_links_column("source").alias("external"), X.categories_column("source").alias("categories"), X.templates_column("source").alias("templates"))


@query()
def text_forms(s, d):
    rows = _pages(s, d)
    return rows.select("id", X.normal_form_column("title", "NFD").alias("nfd"), X.normal_form_column("title", "NFKC").alias("nfkc"), X.nowiki_column("title").alias("nowiki"), U.anchor_encode("title").alias("anchor"), X.xml_decode_column(S.html_encode("title")).alias("again"))


@query("""select distinct capture_id, requested_id, regexp_full_match(coalesce(requested_id, ''), '[QP][1-9][0-9]*|L[1-9][0-9]*(-[FS][1-9][0-9]*)?') as valid from wikibase""")
def entity_ids(s, d):
    return table(s, d, "wikibase").select("capture_id", "requested_id", wikibase.is_valid_id("requested_id").alias("valid")).distinct()


@query()
def entity_values(s, d):
    return wikibase.property_values(nested.captures(s, d))


@query(f"""with {_LEMMAS}, r as (select *, coalesce(nullif(list_position(['en', 'mul', 'de', 'fr', 'ru'], language), 0), 6) as rank from every where value is not null and language is not null),
  b as (select capture_id, min((rank, language, value)) as b from r group by 1) select capture_id, b[2] as language, b[3] as value from b""")
def entity_lemma(s, d):
    rows = wikibase.lemma(nested.captures(s, d), ["en", "mul", "de", "fr", "ru"])
    return rows.select("capture_id", "lemma.language", "lemma.value")
