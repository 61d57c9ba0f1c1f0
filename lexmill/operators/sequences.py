"""Operators on ordered rows: recency, toggles, merges, layout, carry-forward, batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.operators.ranks import first_per_group, with_position, with_running
from lexmill.session import cut
from lexmill.wikitext import scan


def recency(events: DataFrame, owner: str, item: str, order: list[str], limit: int) -> DataFrame:
    """Each owner's items, newest first, each once, at most limit; a limit of 0 keeps none."""
    last = events.groupBy(owner, item).agg(F.max(F.struct(*order)).alias("_at"))
    if limit < 1:
        return last.select(owner, item, F.lit(0).alias("rank")).where("false")
    return first_per_group(last, [owner], [F.col("_at").desc(), F.col(item)], limit).select(owner, item, "rank")


def toggles(events: DataFrame, owner: str, item: str, order: list[str]) -> DataFrame:
    """Items whose number of toggles is odd, with the last toggle's order columns."""
    counted = events.groupBy(owner, item).agg(F.count("*").alias("n_toggles"), F.max(F.struct(*order)).alias("_at"))
    return counted.where("n_toggles % 2 = 1").select(owner, item, "n_toggles", "_at.*")


def merge_lists(baseline: Column, local: Column, latest: Column, limit: int) -> Column:
    """Three-way merge of lists: what local added or moved comes first, then the latest
    list without what local removed; at most limit."""
    removed = F.array_except(baseline, local)
    added = F.array_except(local, baseline)
    return F.slice(F.array_distinct(F.concat(added, F.array_except(latest, removed))), 1, limit)


def running_score(events: DataFrame, owner: str, order: list[str], right: Column) -> DataFrame:
    """right and wrong answers so far, per owner."""
    w = Window.partitionBy(owner).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    hit = F.when(right, 1).otherwise(0)
    return events.withColumn("n_right", F.sum(hit).over(w)).withColumn("n_wrong", F.sum(1 - hit).over(w))


def evict_oldest(files: DataFrame, order: list[str], size: str, cap: int) -> DataFrame:
    """Files with keep: the newest stay while their sizes add up to no more than cap. Null sizes count 0."""
    placed = with_running(files, [F.col(c).desc() for c in order], size, "_run")
    return placed.withColumn("keep", F.col("_run") <= cap).drop("_run", "position")


def _same_key(a: tuple, b: tuple) -> bool:
    return all(x == y or (x != x and y != y) for x, y in zip(a, b, strict=True))


def in_order(df: DataFrame, group: list[str], order: list[str], start, step, schema: str) -> DataFrame:
    """Rows of each group in order, each with what ``step(state, row)`` gives; ``start()`` makes a group's state.

    Groups come sorted through their task and only the state of one is kept, so
    neither many small groups nor a huge one costs memory or calls.
    """
    columns = df.columns
    n = len(group)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = state = None
        for pdf in frames:
            out = []
            for row in pdf.itertuples(index=False, name=None):
                if state is None or not _same_key(row[:n], key):
                    key, state = row[:n], start()
                out.append(step(state, row))
            yield pd.concat([pdf.reset_index(drop=True), pd.DataFrame(out, columns=added, dtype=object)], axis=1)

    added = [c.split()[0] for c in schema.split(",")]
    shape = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in columns)
    return df.repartition(*group).sortWithinPartitions(*group, *order).mapInPandas(run, f"{shape}, {schema}")


#: Titles of a group that are put into batches in one task.
BATCH_SHARD = 1 << 16


def batches(titles: DataFrame, group: str, order: list[str], title: str, max_count: int, max_chars: int, shard: int = BATCH_SHARD) -> DataFrame:
    """Each group's titles with a batch number; a batch ends at a number of titles or a length. Null titles are left out.

    A group is cut into shards of its order, each of which begins a batch, so a
    group of any size is spread over tasks; a null group is one too.
    """
    kept = list(dict.fromkeys([group, *order, title]))
    at = kept.index(title)

    def step(state: list[int], row: tuple) -> tuple[int]:
        size = len(row[at + 1].encode()) + 1
        if state[1] and (state[1] >= max_count or state[2] + size > max_chars):
            state[:] = [state[0] + 1, 0, 0]
        state[1] += 1
        state[2] += size
        return (state[0],)

    key = F.struct(group)
    placed = with_position(titles.select(*kept).where(F.col(title).isNotNull()), list(dict.fromkeys([group, *order])))
    begins = placed.groupBy(key.alias("_group")).agg(F.min("position").alias("_begin"))
    cutting = placed.withColumn("_group", key).join(begins, "_group").withColumn("_shard", F.floor((F.col("position") - F.col("_begin")) / shard)).select("_shard", *kept)
    local = cut(in_order(cutting, ["_shard", group], order, lambda: [0, 0, 0], step, "local int"))
    counts = local.groupBy(key.alias("_group"), "_shard").agg((F.max("local") + 1).alias("_n"))
    before = Window.partitionBy("_group").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_group", "_shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return local.withColumn("_group", key).join(starts, ["_group", "_shard"]).select(*kept, (F.col("_start") + F.col("local")).cast("int").alias("batch"))


# wikitext lines and sections


def line_kind(line: Column) -> tuple[Column, Column, Column]:
    """(kind, depth, body) of a line, in the JVM."""
    prefix = F.regexp_extract(line, "^[#*:;]+", 0)
    last = F.right(prefix, F.lit(1))
    hash_first = prefix.startswith("#")
    kind = (
        F.when(prefix == "", F.when(F.trim(line) == "", "blank").otherwise("paragraph"))
        .when(hash_first & (last == "#"), "definition")
        .when(hash_first & (last == ":"), "example")
        .when(hash_first & (last == "*"), "quotation")
        .when(hash_first, "list_detail")
        .when(last.isin("*", "#"), "list_item")
        .when(last == ";", "term")
        .when(prefix.contains("*"), "list_detail")
        .otherwise("indent")
    )
    return kind, F.least(F.char_length(prefix), F.lit(255)), F.regexp_replace(F.substring(line, F.char_length(prefix) + 1, 2147483647), r"^[ \t]+", "")


def blocks(pages: DataFrame, key: list[str], body: str) -> DataFrame:
    """key, ord, kind, depth, body: one row per line."""
    lines = pages.select(*key, F.posexplode(F.split(body, "\r?\n")).alias("ord", "line"))
    kind, depth, rest = line_kind(F.col("line"))
    return lines.select(*key, "ord", kind.alias("kind"), depth.alias("depth"), rest.alias("body"))


def section_rows(pages: DataFrame, key: list[str], body: str, levels: tuple[int, ...] = (1, 2)) -> DataFrame:
    """key, ord, level, heading, source: the sections of each page."""
    schema = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in key)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(*k, *s) for *k, text in pdf[[*key, body]].itertuples(index=False, name=None) if text is not None for s in scan.sections(text, levels)]
            yield pd.DataFrame(rows, columns=[*key, "ord", "level", "heading", "source"])

    return pages.select(*key, body).mapInPandas(run, f"{schema}, ord int, level int, heading string, source string")


def heading_rows(pages: DataFrame, key: list[str], body: str) -> DataFrame:
    """key, ord, level, heading: every heading of each page outside of hidden regions, of all
    levels, in order; ord 0 is the lead without a heading. Pages without text have no rows."""
    schema = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in key)

    def headings(text: str) -> Iterator[tuple[int, str]]:
        hidden = iter([*scan.opaque_spans(text), (len(text) + 1, len(text) + 1)])
        begin, end = next(hidden)
        at = 0
        yield 0, ""
        for line in text.split("\n"):
            start, at = at, at + len(line) + 1
            while end <= start:
                begin, end = next(hidden)
            if begin >= start and (found := scan.heading(line.rstrip("\r"))):
                yield found

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(*k, i, *x) for *k, text in pdf.itertuples(index=False, name=None) if text is not None for i, x in enumerate(headings(text))]
            yield pd.DataFrame(rows, columns=[*key, "ord", "level", "heading"])

    return pages.select(*key, F.col(body).alias("_body")).mapInPandas(run, f"{schema}, ord int, level int, heading string")


def resolved_languages(sections: DataFrame, key: list[str], languages: DataFrame, fallback: str) -> DataFrame:
    """Sections with a language: by heading; unresolved ones go on with the language before,
    leading ones take the first that follows, a page without any takes the fallback.

    languages: name, code; a short dimension that Catalyst may broadcast.
    """
    known = sections.join(languages.select(F.lower("name").alias("_n"), "code").dropDuplicates(["_n"]), F.lower(F.trim("heading")) == F.col("_n"), "left").drop("_n")
    before = Window.partitionBy(*key).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy(*key).orderBy("ord").rowsBetween(0, Window.unboundedFollowing)
    code = F.coalesce(F.last("code", True).over(before), F.first("code", True).over(behind), F.lit(fallback))
    return known.withColumn("language", code).drop("code")


def language_groups(sections: DataFrame, key: list[str]) -> DataFrame:
    """key, language, first_ord, source: sections of one language joined in order."""
    grouped = sections.groupBy(*key, "language").agg(F.min("ord").alias("first_ord"), F.sort_array(F.collect_list(F.struct("ord", "source"))).alias("s"))
    return grouped.select(*key, "language", "first_ord", F.array_join(F.transform("s", lambda x: x["source"]), "\n").alias("source"))


def sense_layout(lines: DataFrame, key: list[str]) -> DataFrame:
    """key, ord, kind, depth, parent, sense: definitions under the nearest shallower open
    definition, evidence at the open definition of its depth (null: none is open).

    A definition closes the deeper ones. Depths are at most 255, mostly below 5.
    """
    n = len(key)

    def step(open_: dict[int, int], row: tuple) -> tuple[int | None, int | None]:
        at, kind, depth = row[n:]
        parent = sense = None
        if kind == "definition":
            for d in [d for d in open_ if d >= depth]:
                del open_[d]
            parent = open_[max(open_)] if open_ else None
            open_[depth] = at
        elif kind in ("example", "quotation", "list_detail"):
            sense = open_.get(depth - 1)
        return parent, sense

    return in_order(lines.select(*key, "ord", "kind", "depth"), key, ["ord"], dict, step, "parent int, sense int")


def part_of_speech(heading: Column) -> Column:
    """The part of speech a heading names, number allowed; null for others."""
    bare = F.lower(F.regexp_replace(F.trim(heading), "^(.*[^ ])[ ][0-9]+$", "$1"))
    names = F.create_map(*[F.lit(x) for name in scan.PARTS_OF_SPEECH for x in (name.lower(), name)])
    return names[bare]


def section_kind(heading: Column) -> Column:
    """etymology, translations, references, quotations or relations; null for others."""
    bare = F.lower(F.regexp_replace(F.trim(heading), "^(.*[^ ])[ ][0-9]+$", "$1"))
    out = F.lit(None).cast("string")
    for kind, names in scan.SECTION_KINDS.items():
        out = F.when(bare.isin(*[n.lower() for n in names]), kind).otherwise(out)
    return out


def lexemes(sections: DataFrame, key: list[str]) -> DataFrame:
    """Sections with kind, lexeme and etymology: the ord of the part of speech they belong to,
    and of the etymology in force, which a level 2 heading ends."""
    w = Window.partitionBy(*key).orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    pos, kind = part_of_speech(F.col("heading")), section_kind(F.col("heading"))
    rows = sections.withColumn("pos", pos).withColumn("kind", kind).withColumn("_part", F.count_if(F.col("level") <= 2).over(w))
    w2 = Window.partitionBy(*key, "_part").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    ety = F.last(F.when(F.col("kind") == "etymology", F.col("ord")), True).over(w2)
    lex = F.last(F.when(F.col("pos").isNotNull(), F.struct("ord", "level")), True).over(w2)
    rows = rows.withColumn("etymology", ety).withColumn("_lex", lex)
    own = F.when(F.col("pos").isNotNull(), F.col("ord")).when(F.col("level") > F.col("_lex.level"), F.col("_lex.ord"))
    return rows.withColumn("lexeme", own).drop("_lex", "_part")
