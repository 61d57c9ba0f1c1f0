"""Compiled entries as a nested table, their validity and their plain text."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.lazy import mapped
from lexmill.wikitext import compiling


def compiled(pages: DataFrame, key: list[str], kind: str = "language") -> DataFrame:
    """key, entry: each page (key, title, language, source) as a nested record; a page without source has none."""
    schema = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in key)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = [(*k, compiling.compile_page(source, title or "", kind, language or "")) for *k, title, language, source in pdf.itertuples(index=False, name=None) if source is not None]
            yield pd.DataFrame(rows, columns=[*key, "entry"])

    named = [F.col(c).alias(f"_{c}") for c in ("title", "language", "source")]  # a key may have one of these names
    return pages.select(*key, *named).mapInPandas(run, f"{schema}, entry {compiling.ENTRY}")


def is_valid(entry: Column) -> Column:
    """Whether all indices of an entry are in range, parents come before their children, and references count from 1."""
    sections, lexemes = entry["sections"], entry["lexemes"]
    n = F.size(sections)

    def lexeme_fits(x: Column) -> Column:
        blocks = F.size(F.get(sections, x["section"])["blocks"])
        inside = lambda at: (at >= 0) & (at < blocks)
        fits = F.forall(
            F.transform(x["definitions"], lambda d, i: F.struct(d.alias("d"), i.alias("i"))),
            lambda p: inside(p["d"]["block"]) & F.coalesce(p["d"]["parent"] < p["i"], F.lit(True)) & F.forall(F.concat(p["d"]["examples"], p["d"]["quotations"], p["d"]["notes"]), inside),
        )
        return (x["section"] >= 0) & (x["section"] < n) & F.coalesce(x["etymology"] < n, F.lit(True)) & fits

    return (
        (entry["title"] != "")
        & F.forall(lexemes, lexeme_fits)
        & F.forall(entry["other_sections"], lambda i: (i >= 0) & (i < n))
        & F.forall(F.transform(entry["references"], lambda r, i: r["number"] == i + 1), lambda ok: ok)
    )


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: s["text"]), "")


def plain_text(entry: Column) -> Column:
    """Headings and blocks of an entry, one per line."""
    lines = F.transform(
        entry["sections"],
        lambda s: F.concat(F.when(s["title"] != "", F.array(F.concat(F.lit("## "), s["title"]))).otherwise(F.array().cast("array<string>")), F.transform(s["blocks"], lambda b: F.concat(F.repeat(F.lit("  "), F.greatest(b["depth"] - 1, F.lit(0))), spans_text(b["spans"])))),
    )
    return F.array_join(F.flatten(lines), "\n")


def metrics(entry: Column) -> Column:
    """sections, blocks, spans, tables and the longest text of an entry."""
    blocks = F.flatten(F.transform(entry["sections"], lambda s: s["blocks"]))
    spans = F.flatten(F.transform(blocks, lambda b: b["spans"]))
    return F.struct(
        F.size(entry["sections"]).alias("n_sections"),
        F.size(blocks).alias("n_blocks"),
        F.size(spans).alias("n_spans"),
        F.size(F.filter(blocks, lambda b: b["kind"] == "table")).alias("n_tables"),
        F.coalesce(F.array_max(F.transform(spans, lambda s: F.char_length(s["text"]))), F.lit(0)).alias("longest"),
    )


def display_title(shown: Column, title: Column) -> Column:
    """The display title if its plain text is the title, else the title; and whether one was rejected."""
    text = spans_text(shown)
    return F.struct(F.when(text == title, text).otherwise(title).alias("text"), (F.size(shown) > 0).__and__(text != title).alias("rejected"))


def _grid(rows: list[list[str]]) -> str:
    """A table as aligned text: columns as wide as their widest cell, wide letters counted as two."""
    width = lambda x: sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in x)
    n = max((len(r) for r in rows), default=0)
    widest = [max((width(r[i]) for r in rows if i < len(r)), default=0) for i in range(n)]
    lines = []
    for row in rows:
        cells = [*row, *[""] * (n - len(row))]
        lines.append("| " + " | ".join(c + " " * (w - width(c)) for c, w in zip(cells, widest, strict=True)) + " |")
    if len(lines) > 1:
        lines.insert(1, "|-" + "-|-".join("-" * w for w in widest) + "-|")
    return "\n".join(lines)


def table_text(rows: Column) -> Column:
    """Rows of cells of spans as aligned text, the first row as the head; an empty table is empty."""
    cells = F.transform(rows, lambda r: F.transform(r, lambda c: F.regexp_replace(spans_text(c), r"\s+", " ")))
    return mapped(lambda t: _grid([list(r) for r in t]), "string", cells)
