"""The general problems of a training-data pipeline, as named queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.operators import hierarchy, nested, orphans, snapshots

QUERIES = {
    "p2_found": lambda s, d: orphans.orphan_references(*orphans.relations(s, d)),
    "p2_report": orphans.orphans_report,
    "p3_found": hierarchy.found,
    "p3_hierarchy": lambda s, d: hierarchy.category_tree(s, d).withColumn("path", F.array_join("path", " > ", "?")),
    "p3_descendants": lambda s, d: hierarchy.descendants(hierarchy.category_tree(s, d, paths=False)),
    "p5_found": nested.found,
    "p5_lemmas": lambda s, d: nested.lemmas_table(nested.captures(s, d)).distinct(),
    "p5_statements": lambda s, d: nested.claims_table(nested.captures(s, d)).drop("body").distinct(),
    "p5_snaks": lambda s, d: nested.snaks_table(nested.captures(s, d)).distinct(),
    "p5_parts": lambda s, d: nested.parts_table(nested.captures(s, d)).select("capture_id", "node_path", "kind", "position", "part_id", F.array_join("features", ",").alias("features"), F.to_json("texts").alias("texts")).distinct(),
    "p6_found": snapshots.bundle_changes,
    "p6_summary": lambda s, d: snapshots.bundle_changes(s, d).groupBy("snapshot_id", "change_kind").agg(F.count("*").alias("n_pages")),
}

_STATES = """
with stamped as (
  select snapshot_id, page_id, revision_id,
    cast(replace(substr(revision_timestamp, 1, 19), 'T', ' ') as timestamp)
      - case when substr(revision_timestamp, 20, 1) in ('+', '-')
          then (case substr(revision_timestamp, 20, 1) when '+' then 1 else -1 end)
            * (cast(substr(revision_timestamp, 21, 2) as int) * interval 1 hour + cast(substr(revision_timestamp, 24, 2) as int) * interval 1 minute)
          else interval 0 hour end as instant
  from bundle_pages),
ranked as (
  select *, row_number() over (partition by snapshot_id, page_id order by revision_id desc nulls last, instant desc nulls last) as rn from stamped),
states as (select snapshot_id, page_id, revision_id, instant from ranked where rn = 1),
snaps as (select snapshot_id, lead(snapshot_id) over (order by snapshot_id) as later from (select distinct snapshot_id from bundle_pages)),
old as (select s.later as snapshot_id, t.page_id, t.revision_id, t.instant from states t join snaps s using (snapshot_id) where s.later is not null),
new as (select t.* from states t join snaps s on t.snapshot_id = s.later),
changes as (
  select coalesce(n.snapshot_id, o.snapshot_id) as snapshot_id, coalesce(n.page_id, o.page_id) as page_id,
    case when o.page_id is null then 'added' when n.page_id is null then 'removed' else 'changed' end as change_kind
  from new n full join old o on n.snapshot_id = o.snapshot_id and n.page_id = o.page_id
  where o.page_id is null or n.page_id is null or o.revision_id is distinct from n.revision_id or o.instant is distinct from n.instant)
"""

_TREE = """
with recursive nodes as (select id, min(title) as title from targets where id is not null group by id),
edges as (
  select n.id as child, min(l.target) as parent
  from (select distinct id, title from targets) n
  join (select distinct id, category_key from pages where category_key is not null) p on p.category_key = n.title
  join (select distinct from_id, target from links where kind = 1) l on l.from_id = p.id
  where l.target in (select id from targets) group by n.id),
up as (
  select id as start, id as here, 0 as steps, [id] as seen, title as path, false as cyc, id as low from nodes
  union all
  select u.start, e.parent, u.steps + 1, list_append(u.seen, e.parent), n.title || ' > ' || u.path, list_contains(u.seen, e.parent), 0
  from up u join edges e on e.child = u.here join nodes n on n.id = e.parent where not u.cyc),
last as (select * from up u where cyc or not exists (select 1 from edges e where e.child = u.here))
"""

_TREE_ROWS = """, rows as (
  select start as node_id, (select parent from edges where child = start) as parent_id,
    case when cyc then list_min(list_slice(seen, list_position(seen, here), len(seen))) else here end as root_id,
    case when cyc then -1 else steps end as depth, cyc as in_cycle, case when cyc then null else path end as path from last)
"""



def _plain_json(column: str) -> str:
    return f"case when not json_valid({column}) then null when json_type(cast({column} as json)) <> 'VARCHAR' then cast({column} as json) when json_valid(json_extract_string({column}, '$')) then cast(json_extract_string({column}, '$') as json) end as {column}"


def _list(x: str) -> str:
    return f"case json_type({x}) when 'ARRAY' then cast({x} as json[]) when 'OBJECT' then [{x}] else cast([] as json[]) end"


_NESTED = f"""
with src as (select distinct capture_id, claims, forms, senses from wikibase),
n as (select capture_id, {_plain_json("claims")}, {_plain_json("forms")}, {_plain_json("senses")} from src),
parts as (
  select capture_id, 'forms/' || generate_subscripts(l, 1) as owner, unnest(l) as x from (select capture_id, {_list("forms")} as l from n)
  union all select capture_id, 'senses/' || generate_subscripts(l, 1), unnest(l) from (select capture_id, {_list("senses")} as l from n)),
owners as (select capture_id, '' as owner, claims from n union all select capture_id, owner, json_extract(x, '$.claims') from parts where json_type(x) = 'OBJECT'),
props as (select capture_id, owner, claims, unnest(json_keys(claims)) as property from owners where json_type(claims) = 'OBJECT'),
lists as (select capture_id, owner, property, json_extract(claims, '$."' || property || '"') as x from props),
st as (select capture_id, owner, property, generate_subscripts(l, 1) as position, unnest(l) as x from (select *, {_list("x")} as l from lists)),
statements as (select capture_id, case owner when '' then '' else owner || '/' end || 'claims/' || property || '/' || position as node_path, owner as parent_path, property, position, x from st),
refs as (select capture_id, node_path, generate_subscripts(l, 1) as j, unnest(l) as x from (select capture_id, node_path, {_list("json_extract(x, '$.references')")} as l from statements)),
groups as (
  select capture_id, node_path as parent_path, 'qualifier' as role, node_path || '/qualifiers/' as base, json_extract(x, '$.qualifiers') as g from statements
  union all select capture_id, node_path, 'reference', node_path || '/references/' || j || '/', json_extract(x, '$.snaks') from refs),
keyed as (select *, unnest(json_keys(g)) as property from groups where json_type(g) = 'OBJECT'),
valued as (select capture_id, parent_path, role, base, property, json_extract(g, '$."' || property || '"') as x from keyed),
placed as (select capture_id, parent_path, role, base, property, generate_subscripts(l, 1) as position, unnest(l) as x from (select *, {_list("x")} as l from valued)),
snaks as (
  select capture_id, node_path || '/mainsnak' as node_path, node_path as parent_path, 'mainsnak' as role, property, 1 as position, json_extract(x, '$.mainsnak') as x from statements
  union all select capture_id, base || property || '/' || position, parent_path, role, property, position, x from placed)
"""
_LEMMAS = """
lj as (select distinct capture_id, case when json_valid(lemmas) and lemmas like '"%' then json_extract_string(lemmas, '$') else lemmas end as j from wikibase),
lv as (select capture_id, cast(j as json) as j from lj where json_valid(j)),
mapped as (select capture_id, unnest(json_keys(j)) as language, j from lv where json_type(j) = 'OBJECT'),
valued_l as (select capture_id, language, json_extract(j, '$."' || language || '"') as x from mapped),
listed as (select capture_id, unnest(cast(j as json[])) as x from lv where json_type(j) = 'ARRAY'),
every as (
  select capture_id, language, case when json_type(x) = 'OBJECT' then json_extract_string(x, '$.value') else json_extract_string(x, '$') end as value from valued_l
  union all select capture_id, json_extract_string(x, '$.language'), json_extract_string(x, '$.value') from listed)
"""

_PARTS = f"""
with src as (select distinct capture_id, forms, senses from wikibase), n as (select capture_id, {_plain_json("forms")}, {_plain_json("senses")} from src),
parts as (
  select capture_id, 'forms' as kind, generate_subscripts(l, 1) as position, unnest(l) as x from (select capture_id, {_list("forms")} as l from n)
  union all select capture_id, 'senses', generate_subscripts(l, 1), unnest(l) from (select capture_id, {_list("senses")} as l from n)),
kept as (select capture_id, kind, position, x, coalesce(json_extract(x, '$.representations'), json_extract(x, '$.glosses')) as t from parts where json_type(x) = 'OBJECT'),
features as (select *, array_to_string(list_transform({_list("json_extract(x, '$.grammaticalFeatures')")}, lambda f: json_extract_string(f, '$')), ',') as features from kept)
"""

SQL = {
    "p5_snaks": _NESTED + """select distinct capture_id, node_path, parent_path, role, property, cast(position as int) as position, json_extract_string(x, '$.snaktype') as snaktype, json_extract_string(x, '$.datatype') as datatype,
      case when json_type(json_extract(x, '$.datavalue')) = 'NULL' then null else json_extract_string(x, '$.datavalue') end as datavalue from snaks where json_type(x) = 'OBJECT'""",
    "p5_parts": _PARTS + """select distinct capture_id, kind || '/' || position as node_path, kind, cast(position as int) as position, json_extract_string(x, '$.id') as part_id, features,
      '[' || coalesce(case when json_type(t) = 'OBJECT' then array_to_string(list_transform(json_keys(t), lambda k: '{"language":"' || k || '"' || coalesce(',"value":' || case when json_extract(json_extract(t, '$."' || k || '"'), '$.value') <> 'null' then cast(json_extract(json_extract(t, '$."' || k || '"'), '$.value') as varchar) end, '') || '}'), ',') end, '') || ']' as texts from features""",
    "p3_hierarchy": _TREE + """, down as (select here as node, count(*) - 1 as n_descendants from up u where exists (select 1 from last l where l.start = u.start and not l.cyc) group by here)
      select l.start as node_id, (select parent from edges where child = l.start) as parent_id, case when l.cyc then list_min(list_slice(l.seen, list_position(l.seen, l.here), len(l.seen))) else l.here end as root_id,
        cast(case when l.cyc then -1 else l.steps end as int) as depth, case when not l.cyc then row_number() over (partition by l.cyc, l.here order by list_reverse(l.seen)) - 1 end as pre,
        case when not l.cyc then d.n_descendants end as n_descendants, l.cyc as in_cycle, case when l.cyc then null else l.path end as path from last l left join down d on d.node = l.start""",
    "p5_found": _NESTED + "," + _LEMMAS + """select capture_id, node_path from snaks where json_type(x) = 'OBJECT'
      union select capture_id, 'lemmas/' || language from every where value is not null and language is not null""",
    "p5_statements": _NESTED + """select distinct capture_id, node_path, parent_path, property, cast(position as int) as position, json_extract_string(x, '$.id') as claim_id, json_extract_string(x, '$.rank') as rank, json_extract_string(x, '$.type') as type from statements""",
    "p3_found": _TREE + _TREE_ROWS + "select node_id, root_id, cast(depth as integer) as depth from rows where parent_id is not null",
    "p3_descendants": _TREE + """select u.here as node_id, u.start as descendant_id, cast(u.steps as integer) as steps
        from up u join last l on l.start = u.start where not l.cyc and u.steps > 0""",
    "p5_lemmas": """
with t as (select distinct capture_id, case when json_valid(lemmas) and lemmas like '"%' then json_extract_string(lemmas, '$') else lemmas end as j from wikibase),
v as (select capture_id, cast(j as json) as j from t where json_valid(j)),
mapped as (select capture_id, unnest(json_keys(j)) as language, j from v where json_type(j) = 'OBJECT'),
valued as (select capture_id, language, json_extract(j, '$."' || language || '"') as x from mapped),
listed as (select capture_id, unnest(cast(j as json[])) as x from v where json_type(j) = 'ARRAY'),
every as (
  select capture_id, language, case when json_type(x) = 'OBJECT' then json_extract_string(x, '$.value') else json_extract_string(x, '$') end as value from valued
  union all select capture_id, json_extract_string(x, '$.language'), json_extract_string(x, '$.value') from listed)
select distinct capture_id, 'lemmas/' || language as node_path, language, value from every where value is not null and language is not null""",
    "p6_found": _STATES + "select snapshot_id, page_id, change_kind from changes",
    "p6_summary": _STATES + "select snapshot_id, change_kind, count(*) as n_pages from changes group by all",
}
