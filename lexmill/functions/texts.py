"""Text functions that only Python can express, as Columns."""

from __future__ import annotations

import html
import re
import unicodedata
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions import lazy
from lexmill.functions.lazy import mapped
from lexmill.wikitext import expand, prepared, presenting, scan

# Entities of XML, read in one pass.
XML_ENTITIES = {"lt": "<", "gt": ">", "amp": "&", "quot": '"', "apos": "'"}


def xml_decode(text: str, repeated: bool = False) -> str:
    """XML entities and character references; repeated: until nothing changes, 8 times at most."""

    def one(m: re.Match) -> str:
        name = m[1]
        if name in XML_ENTITIES:
            return XML_ENTITIES[name]
        if name[0] == "#":
            code = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
            if 0 < code < 0x110000 and not 0xD800 <= code < 0xE000:
                return chr(code)
        return m[0]

    for _ in range(8 if repeated else 1):
        done = re.sub(r"&(#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,7}|[A-Za-z]+);", one, text)
        if done == text:
            break
        text = done
    return text


def html_decode(text: str, named: bool = False) -> str:
    """Numeric and the basic entities; all named ones only if asked for; unknown ones stay."""

    def one(m: re.Match) -> str:
        name = m[1]
        if name[0] == "#" or name in XML_ENTITIES or name == "nbsp" or (named and name + ";" in html5):
            return html.unescape(m[0])
        return m[0]

    return re.sub(r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);", one, text)


def utf8_repaired(raw: bytes) -> str:
    """Each byte that is not part of valid UTF-8 becomes one replacement character."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode("utf-8"))
            break
        except UnicodeDecodeError as e:
            out.append(raw[at : at + e.start].decode("utf-8"))
            out.append("�")
            at += e.start + 1
    return "".join(out)


def xml_decode_column(x, repeated: bool = False) -> Column:
    return mapped(lambda t: xml_decode(t, repeated), "string", x)


def html_decode_column(x, named: bool = False) -> Column:
    return mapped(lambda t: html_decode(t, named), "string", x)


def utf8_repaired_column(x) -> Column:
    return mapped(lambda b: utf8_repaired(bytes(b)), "string", x)


def normal_form_column(x, form: str) -> Column:
    """NFC, NFD, NFKC or NFKD."""
    return mapped(lambda t: unicodedata.normalize(form, t), "string", x)


def nowiki_column(x) -> Column:
    return mapped(scan.nowiki, "string", x)


def comments_stripped_column(x) -> Column:
    return mapped(expand.strip_comments, "string", x)


def transcluded_column(x) -> Column:
    return mapped(expand.transcluded, "string", x)


def heading_column(x) -> Column:
    """struct<level, title> of a heading line, else null."""

    def one(line: str):
        found = scan.heading(line)
        return None if found is None else {"level": found[0], "title": found[1]}

    return mapped(one, "struct<level:int,title:string>", x)


def links_column(x) -> Column:
    return mapped(scan.links, "array<struct<target:string,label:string,piped:boolean,trail:string>>", x)


def external_links_column(x) -> Column:
    return mapped(scan.external_links, "array<struct<url:string,label:string>>", x)


def free_urls_column(x) -> Column:
    return mapped(scan.free_urls, "array<string>", x)


def categories_column(x) -> Column:
    return mapped(scan.categories, "array<struct<name:string,sortkey:string>>", x)


def emphasis_column(x) -> Column:
    return mapped(lambda t: [dict(zip(("text", "bold", "italic"), r, strict=True)) for r in scan.emphasis(t)], "array<struct<text:string,bold:boolean,italic:boolean>>", x)


def template_column(x) -> Column:
    """name and params of the text between the braces of a template."""

    def one(body: str):
        name, params = expand.parse_template(body)
        return {"name": name, "params": [{"key": k, "named": n, "value": v} for k, n, v in params]}

    return mapped(one, "struct<name:string,params:array<struct<key:string,named:boolean,value:string>>>", x)


def templates_column(x) -> Column:
    """All template calls of a text, inner ones first, as (name, number of parameters)."""

    def one(text: str):
        visible = scan.visible(text)
        out = []
        for start, end, kind in scan.pairs(text):
            if kind == "{{":
                name, params = expand.parse_template(visible[start + 2 : end - 2])
                out.append({"name": name, "n_params": len(params)})
        return out

    return mapped(one, "array<struct<name:string,n_params:int>>", x)


def expanded_column(source, title, pages: dict[str, str] | None = None, **settings) -> Column:
    """The source expanded; pages by name is a small map, checked by ``expansion.expanded``."""
    pages = pages or {}

    def one(text: str, name: str):
        return prepared.whole(text, expand.Context(title=name or "", pages=pages.get, exists=pages.__contains__, **settings))

    return mapped(one, "string", source, title)


def filled_column(text: str, value, **settings) -> Column:
    """The text with each value at its open places (``prepared.OPEN``) expanded, on a page without title."""
    return lazy.prepared(lambda: prepared.prepared(text, expand.Context(**settings)), "string", value)


def presented_column(body, title=None) -> Column:
    """The spans of the template between the braces, null if it is in no family that is presented."""
    names = ("text", "target", "role", "language", "bold", "italic", "small", "superscript", "subscript", "code")

    def one(text: str, name: str | None = None):
        spans = presenting.presented(text, name or "")
        return None if spans is None else [{n: bool(s.get(n)) if n in names[4:] else s.get(n) for n in names} for s in spans]

    flags = ",".join(f"{n}:boolean" for n in names[4:])
    return mapped(one, f"array<struct<text:string,target:string,role:string,language:string,{flags}>>", body, *([title] if title is not None else []))


def presented_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: s["text"]), "")
