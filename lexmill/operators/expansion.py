"""Expansion of whole tables of pages."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators import graphs
from lexmill.session import cut
from lexmill.wikitext import expand

#: Templates of at most so many bytes are sent to all tasks at once.
BROADCAST_BYTES = 32 << 20

_KNOWN = "array<struct<kind:string,name:string,source:string>>"
_ASKS = "array<struct<kind:string,name:string>>"


class _Answers:
    """Templates and existing titles one page may see, and what it asked for beyond them.

    A template or title that is known to be absent has a null source; one that is
    neither known nor everywhere is written down, so the page can come back with it.
    """

    def __init__(self, known: dict[tuple[str, str], str | None], everywhere: dict[str, str] | None, titled: bool):
        self.known, self.everywhere, self.titled = known, everywhere, titled
        self.asked: dict[tuple[str, str], None] = {}

    def _of(self, kind: str, name: str) -> str | None:
        if (kind, name) not in self.known:
            self.asked[kind, name] = None
        return self.known.get((kind, name))

    def page(self, name: str) -> str | None:
        return self.everywhere.get(name) if self.everywhere is not None else self._of("template", name)

    def exists(self, title: str) -> bool:
        if self.titled:
            return self._of("title", title) is not None
        return self.page(title) is not None


def _expander(schema_key: list[str], modules: dict, settings: dict, titled: bool, shared=None):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        everywhere = shared.value if shared is not None else None
        for pdf in frames:
            rows = []
            for *key, title, text, own in pdf[[*schema_key, "_title", "_source", "known"]].itertuples(index=False, name=None):
                if text is None:
                    rows.append((*key, None, None, None, None, []))
                    continue
                known = {(x["kind"], x["name"]): x["source"] for x in own} if hasattr(own, "__len__") else {}
                answers = _Answers(known, everywhere, titled)
                context = expand.Context(title=title or "", pages=answers.page, exists=answers.exists, modules=modules, **settings)
                try:
                    done, reason = expand.Expander(context).expand(expand.strip_comments(expand.own(text))), None
                except (expand.TemplateError, NotImplementedError, RecursionError) as e:
                    done, reason = None, str(e)
                if answers.asked:
                    rows.append((*key, title, text, None, None, [{"kind": k, "name": n} for k, n in answers.asked]))
                else:
                    rows.append((*key, None, None, done, reason, []))
            yield pd.DataFrame(rows, columns=[*schema_key, "_title", "_source", "expanded", "reason", "asks"])

    return run


def expanded(pages: DataFrame, templates: DataFrame, key: list[str], modules: dict | None = None, broadcast_bytes: int = BROADCAST_BYTES, titles: DataFrame | None = None, **settings) -> DataFrame:
    """key, expanded, reason: each page with its templates replaced; reason says why it could not be.

    pages: key, title, source; templates: name, source (of several the least source
    counts); titles: title, the pages ``#ifexist`` finds (without it: the templates).

    Templates whose text is at most ``broadcast_bytes`` go to every task. Beyond
    that, each page gets the templates it can reach: references are extracted,
    closed over the reference graph and joined to the page. What a page asks for
    and does not have, being named only at expansion or tested by ``#ifexist``, is
    joined to it and the page is expanded again, until it asks for nothing new; so
    both plans give the same rows. Null sources give null without a reason.
    """
    templates = templates.where("name is not null and source is not null").groupBy("name").agg(F.min("source").alias("source"))
    columns = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in key)
    schema = f"{columns}, _title string, _source string, expanded string, reason string, asks {_ASKS}"
    size = templates.agg(F.coalesce(F.sum(F.octet_length("source") + F.octet_length("name")), F.lit(0))).first()[0]
    # a key may have one of these names
    rows = pages.select(*key, F.col("title").alias("_title"), F.col("source").alias("_source"))
    small, result = size <= broadcast_bytes, [*key, "expanded", "reason"]
    if small:
        shared = pages.sparkSession.sparkContext.broadcast({r["name"]: r["source"] for r in templates.toLocalIterator()})
        state, edges = rows.withColumn("known", F.lit(None).cast(_KNOWN)), None
        if titles is None:
            return state.mapInPandas(_expander(key, modules or {}, settings, False, shared), schema).select(*result)
    else:
        shared, edges = None, cut(_edges(templates))
        needs = _closed(_direct(rows, key, "_source"), edges, key)
        state = rows.join(_collected(_answered(needs.select(*key, F.lit("template").alias("kind"), "name"), templates, titles), key), key, "left")
    run, done = _expander(key, modules or {}, settings, titles is not None, shared), []
    while True:
        ran = cut(state.mapInPandas(run, schema))
        done.append(ran.where("size(asks) = 0").select(*result))
        waiting = ran.where("size(asks) > 0")
        if waiting.isEmpty():
            return reduce(DataFrame.unionByName, done)
        asks = waiting.select(*key, F.explode("asks").alias("x")).select(*key, "x.*").distinct()
        if edges is not None:
            more = _closed(asks.where("kind = 'template'").select(*key, "name"), edges, key)
            asks = asks.where("kind <> 'template'").unionByName(more.select(*key, F.lit("template").alias("kind"), "name"))
        before = state.select(*key, F.explode("known").alias("x")).select(*key, "x.*")
        # a null in the key is a value of its own: it comes from the same page again
        known = _collected(before.unionByName(_answered(asks, templates, titles)).distinct(), key)
        same = reduce(lambda a, b: a & b, [F.col(f"w.{c}").eqNullSafe(F.col(f"k.{c}")) for c in key])
        state = waiting.select(*key, "_title", "_source").alias("w").join(known.alias("k"), same).select(*[f"w.{c}" for c in key], "w._title", "w._source", "k.known")


def _answered(asks: DataFrame, templates: DataFrame, titles: DataFrame | None) -> DataFrame:
    """(key, kind, name, source) of asks: the source of a template, the title of a page, null for none."""
    have = templates.select(F.lit("template").alias("kind"), "name", "source")
    if titles is not None:
        known = titles.where("title is not null").select(F.lit("title").alias("kind"), F.col("title").alias("name"), F.col("title").alias("source")).distinct()
        have = have.unionByName(known)
    return asks.join(have, ["kind", "name"], "left").select(*[c for c in asks.columns if c not in ("kind", "name")], "kind", "name", "source")


def _collected(answers: DataFrame, key: list[str]) -> DataFrame:
    return answers.groupBy(*key).agg(F.collect_list(F.struct("kind", "name", "source")).alias("known"))


def _direct(pages: DataFrame, key: list[str], body: str = "source") -> DataFrame:
    return graphs.references(pages, key, body).where("kind = 'template'").select(*key, F.col("target").alias("name")).distinct()


def _edges(templates: DataFrame) -> DataFrame:
    return graphs.references(templates, ["name"], "source", included=True).where("kind = 'template'").select(F.col("name").alias("src"), F.col("target").alias("dst")).distinct()


def _closed(direct: DataFrame, edges: DataFrame, key: list[str]) -> DataFrame:
    """(key, name): direct and all that edges lead to from it. Each round takes the last one's finds one step on."""
    seen = frontier = cut(direct)
    while True:
        new = frontier.join(edges, frontier["name"] == edges["src"]).select(*key, F.col("dst").alias("name")).distinct()
        frontier = cut(new.join(seen, [*key, "name"], "left_anti"))
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)


def reached_templates(pages: DataFrame, templates: DataFrame, key: list[str]) -> DataFrame:
    """(key, name): the templates each page can reach, over any number of steps."""
    return _closed(_direct(pages, key), cut(_edges(templates)), key)
