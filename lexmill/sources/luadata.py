"""Data from source that assigns literal tables, read without running it.

Only literals are read: texts, numbers, true, false, nil, tables, and
assignments of them to ``name["key"]``, ``name.key`` or ``return``. Any other
expression refuses the whole source.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.lazy import mapped

_TOKEN = re.compile(
    r"""\s+|--\[(?P<c>=*)\[.*?\](?P=c)\]|--[^\n]*|(?P<text>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')|\[(?P<e>=*)\[\n?(?P<long>.*?)\](?P=e)\]|(?P<number>-?(?:0[xX][0-9a-fA-F]+|[0-9]+\.?[0-9]*(?:[eE][-+]?[0-9]+)?))"""
    r"""|(?P<name>[A-Za-z_][A-Za-z0-9_]*)|(?P<sign>[{}\[\]=,;.])""",
    re.S,
)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "b": "\b", "f": "\f", "v": "\v", "\n": "\n"}
MAX_NESTING = 200


class NotLiteral(ValueError):
    pass


def _unquoted(text: str) -> str:
    def one(m: re.Match) -> str:
        return chr(int(m[1])) if m[1] else _ESCAPES.get(m[2], m[2])

    # decimal escapes name bytes
    raw = re.sub(r"\\(?:([0-9]{1,3})|(.))", one, text[1:-1], flags=re.S)
    if re.search(r"\\[0-9]", text) and all(ord(c) < 256 for c in raw):
        return raw.encode("latin-1").decode("utf-8", "replace")
    return raw


def _tokens(source: str):
    at = 0
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise NotLiteral(f"no literal at {at}")
        at = m.end()
        if m["text"] is not None:
            yield "value", _unquoted(m["text"])
        elif m["long"] is not None:
            yield "value", m["long"]
        elif m["number"]:
            n = m["number"]
            yield "value", int(n, 16) if "x" in n.lower() else float(n) if re.search("[.eE]", n) else int(n)
        elif m["name"]:
            yield ("value", {"true": True, "false": False, "nil": None}[m["name"]]) if m["name"] in ("true", "false", "nil") else ("name", m["name"])
        elif m["sign"]:
            yield "sign", m["sign"]
    yield "end", None


class _Reader:
    def __init__(self, source: str):
        self.tokens = list(_tokens(source))
        self.at = 0

    def next(self):
        self.at += 1
        return self.tokens[self.at - 1]

    def peek(self, sign: str, ahead: int = 0) -> bool:
        return self.tokens[min(self.at + ahead, len(self.tokens) - 1)] == ("sign", sign)

    def want(self, sign: str) -> None:
        if self.next() != ("sign", sign):
            raise NotLiteral(f"{sign} expected")

    def value(self, depth: int = 0):
        kind, x = self.next()
        if kind == "value":
            return x
        if (kind, x) != ("sign", "{") or depth > MAX_NESTING:
            raise NotLiteral("no literal value")
        out: dict = {}
        place = 0
        while not self.peek("}"):
            if self.peek("["):
                self.next()
                key = self.value(depth + 1)
                self.want("]")
                self.want("=")
                out[key] = self.value(depth + 1)
            elif self.tokens[self.at][0] == "name" and self.peek("=", 1):
                key = self.next()[1]
                self.next()
                out[key] = self.value(depth + 1)
            else:
                place += 1
                out[place] = self.value(depth + 1)
            if not self.peek("}") and self.next() not in (("sign", ","), ("sign", ";")):
                raise NotLiteral("a separator expected")
        self.next()
        return out

    def tables(self) -> dict:
        """What the source assigns, by the keys below its tables, and what it returns."""
        names: dict[str, dict] = {}
        out: dict = {}
        while (token := self.next())[0] != "end":
            if token == ("name", "local"):
                token = self.next()
            if token == ("name", "return"):
                out = names.get(self.next()[1]) if self.tokens[self.at][0] == "name" else self.value()
                if out is None or self.next()[0] != "end":
                    raise NotLiteral("something else is returned")
                return out
            if token[0] != "name":
                raise NotLiteral("an assignment expected")
            path = [token[1]]
            while self.peek("[") or self.peek("."):
                if self.next()[1] == "[":
                    path.append(self.value())
                    self.want("]")
                else:
                    path.append(self.next()[1])
            self.want("=")
            table = names
            for key in path[:-1]:
                table = table.setdefault(key, {})
                if not isinstance(table, dict):
                    raise NotLiteral("a key of no table")
            table[path[-1]] = self.value()
        return next(iter(names.values()), out)


def literal_tables(source: str) -> dict:
    """The table a source returns, or assigns last to its first name; an error if it does anything else."""
    return _Reader(source).tables()


def _json(source: str) -> str | None:
    try:
        return json.dumps(literal_tables(source), ensure_ascii=False, sort_keys=False, default=str)
    except (NotLiteral, KeyError, TypeError, IndexError):
        return None


def literal_json(source) -> Column:
    """The literal table of a source as JSON text; null if the source does more than assign literals."""
    return mapped(_json, "string", source)


def language_rows(sources: DataFrame) -> DataFrame:
    """kind, code, name of language data (source): a table by code whose first value is the
    canonical name, with further names under aliases and otherNames."""
    shape = "map<string,struct<`1`:string,aliases:string,otherNames:string>>"
    rows = sources.select(F.explode(F.from_json(literal_json(F.col("source")), shape)).alias("code", "d"))
    extra = lambda c: F.coalesce(F.map_values(F.from_json(F.col(f"d.{c}"), "map<string,string>")), F.array().cast("array<string>"))
    own = rows.select(F.lit("canonical").alias("kind"), "code", F.col("d.1").alias("name"))
    more = rows.select(F.lit("alias").alias("kind"), "code", F.explode(F.concat(extra("aliases"), extra("otherNames"))).alias("name"))
    return own.unionByName(more).where("name is not null").unionByName(rows.select(F.lit("code").alias("kind"), "code", F.col("code").alias("name"))).distinct()
