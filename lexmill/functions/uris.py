"""URL functions as Column builders."""

from __future__ import annotations

import html
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.lazy import mapped
from lexmill.functions.strings import col

# Characters that wiki URLs keep.
WIKI_KEEP = {"%3B": ";", "%40": "@", "%24": "$", "%21": "!", "%2A": "*", "%28": "(", "%29": ")", "%2C": ",", "%2F": "/", "%7E": "~", "%3A": ":"}


def encode(x, mode: str = "QUERY") -> Column:
    """QUERY (+ for spaces), PATH (%20) or WIKI (_ and some signs kept); an unknown mode is QUERY."""
    x = col(x)
    mode = mode.upper()
    plain = F.replace(F.replace(F.url_encode(x), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    if mode == "PATH":
        return F.replace(plain, F.lit("+"), F.lit("%20"))
    if mode == "WIKI":
        out = F.url_encode(F.replace(x, F.lit(" "), F.lit("_")))
        for code, char in WIKI_KEEP.items():
            out = F.replace(out, F.lit(code), F.lit(char))
        return out
    return plain


def decode(x, mode: str = "QUERY") -> Column:
    """Reads %XX, and + as a space except in PATH; malformed codes give null."""
    x = col(x)
    return F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B")) if mode.upper() == "PATH" else x)


def parts(x) -> Column:
    """protocol, user, host, port, path, query, fragment of a URL; null where absent."""
    x = col(x)
    authority = F.nullif(F.regexp_extract(x, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1), F.lit(""))
    host = F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), r":[0-9]*$", "")
    query, fragment = F.regexp_extract(x, r"\?([^#]*)", 1), F.regexp_extract(x, "#(.*)$", 1)
    return F.struct(
        F.nullif(F.regexp_extract(x, "^([A-Za-z][A-Za-z0-9+.-]*):", 1), F.lit("")).alias("protocol"),
        F.nullif(F.regexp_extract(authority, "^(.*)@", 1), F.lit("")).alias("user"),
        host.alias("host"),
        F.regexp_extract(authority, r":([0-9]+)$", 1).try_cast("int").alias("port"),
        F.regexp_extract(x, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1).alias("path"),
        F.when(x.contains("?"), query).alias("query"),
        F.when(x.contains("#"), fragment).alias("fragment"),
    )


def to_text(p: Column) -> Column:
    """A URL of the struct that ``parts`` gives."""
    nil = F.lit("")
    return F.concat(
        F.coalesce(F.concat(p["protocol"], F.lit(":")), nil),
        F.when(p["host"].isNotNull(), F.concat(F.lit("//"), F.coalesce(F.concat(p["user"], F.lit("@")), nil), p["host"], F.coalesce(F.concat(F.lit(":"), p["port"].cast("string")), nil))).otherwise(nil),
        F.coalesce(p["path"], nil),
        F.coalesce(F.concat(F.lit("?"), p["query"]), nil),
        F.coalesce(F.concat(F.lit("#"), p["fragment"]), nil),
    )


def is_valid(p: Column) -> Column:
    """Whether the parts can stand together: a host has no slash, a path after a host begins with one."""
    return (
        F.coalesce(p["protocol"].rlike(r"^[A-Za-z][A-Za-z0-9+.-]*$"), F.lit(True))
        & F.coalesce(~p["host"].rlike(r"[/?#@:\s]") & (p["host"] != ""), F.lit(True))
        & (p["host"].isNull() | (p["path"] == "") | p["path"].startswith("/"))
        & (p["host"].isNotNull() | ~p["path"].startswith("//"))
    )


def query_map(query) -> Column:
    """key -> list of values in order; a key without = has the value empty."""
    pairs = F.filter(F.split(col(query), "&"), lambda p: p != "")
    keyed = F.transform(pairs, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.when(p.contains("="), F.substring(p, F.instr(p, "=") + 1, F.char_length(p))).otherwise(F.lit("")).alias("v")))
    keys = F.array_distinct(F.transform(keyed, lambda p: p["k"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.transform(F.filter(keyed, lambda p: p["k"] == k), lambda p: p["v"])))


def title_url(title, server: str = "", query: Column | None = None, script: str = "/wiki/") -> Column:
    """local (no server), full or canonical URL of a title; a query goes to the index script."""
    name = encode(title, "WIKI")
    if query is None:
        return F.concat(F.lit(server + script), name)
    plain = F.concat(F.lit(server + script), name)
    return F.when(F.coalesce(query, F.lit("")) == "", plain).otherwise(F.concat(F.lit(server + "/w/index.php?title="), name, F.lit("&"), query))


def _anchor(text: str) -> str:
    text = re.sub(r"\[\[:?([^\]|]*\|)?([^\]]*)\]\]", r"\2", text)
    return re.sub(r"[ _]+", "_", html.unescape(text)).strip("_").replace("%", "%25") if re.search(r"%[0-9a-fA-F]{2}", text) else re.sub(r"[ _]+", "_", html.unescape(text)).strip("_")


def anchor_encode(x) -> Column:
    """The id of a heading: links as their text, entities decoded, spaces as single underscores."""
    return mapped(_anchor, "string", col(x))


# Protocols that make external links.
PROTOCOLS = ("bitcoin:", "ftp://", "ftps://", "geo:", "git://", "gopher://", "http://", "https://", "irc://", "ircs://", "magnet:", "mailto:", "mms://", "news:", "nntp://", "redis://", "sftp://", "sip:", "sips:", "sms:", "ssh://", "svn://", "tel:", "telnet://", "urn:", "worldwind://", "xmpp:", "//")


def has_protocol(x) -> Column:
    return col(x).rlike("(?i)^(?:" + "|".join(re.escape(p) for p in PROTOCOLS) + ")")


def is_external_url(x) -> Column:
    """A known protocol, something after it, and no character that ends a link."""
    return has_protocol(x) & col(x).rlike(r'^[^\s<>"\[\]\x00-\x20\x7f]+$') & col(x).rlike(r"^(?:[A-Za-z]+:)?(?://)?[^\s:/]")
