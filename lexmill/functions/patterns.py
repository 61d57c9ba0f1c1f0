"""Lua patterns as regular expressions.

Patterns without balanced pairs run in the JVM; the rest, and replacements with
a limit, run in Python with the regex library.
"""

from __future__ import annotations

from functools import lru_cache

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.lazy import mapped
from lexmill.functions.strings import col

# The character classes, for bytes (ASCII) and for code points.
CLASSES = {
    False: {"a": "A-Za-z", "d": "0-9", "l": "a-z", "u": "A-Z", "s": " \\t\\n\\r\\f\\x0b", "w": "A-Za-z0-9", "x": "0-9A-Fa-f", "p": "!-/:-@\\[-`{-~", "c": "\\x00-\\x1f\\x7f", "z": "\\x00"},
    True: {"a": "\\p{L}", "d": "\\p{Nd}", "l": "\\p{Ll}", "u": "\\p{Lu}", "s": "\\s\\p{Z}", "w": "\\p{L}\\p{Nd}", "x": "0-9A-Fa-f０-９Ａ-Ｆａ-ｆ", "p": "\\p{P}", "c": "\\p{Cc}", "z": "\\x00"},
}
_SPECIAL = set("\\.^$*+?()[]{}|-&~#")


class PatternError(ValueError):
    pass


def _escape(char: str) -> str:
    return "\\" + char if char in _SPECIAL else char


def _set(pattern: str, at: int, unicode: bool) -> tuple[str, int]:
    """The class that begins behind ``[`` at ``at``, and the place behind its ``]``."""
    out, negated = [], False
    if pattern[at : at + 1] == "^":
        negated, at = True, at + 1
    first = True
    while True:
        if at >= len(pattern):
            raise PatternError("malformed pattern (missing ']')")
        char = pattern[at]
        if char == "]" and not first:
            break
        first = False
        if char == "%" and at + 1 < len(pattern):
            name = pattern[at + 1]
            kind = CLASSES[unicode].get(name.lower())
            out.append((f"[^{kind}]" if name.isupper() else kind) if kind and name.isalpha() else _escape(name))
            at += 2
        elif pattern[at + 1 : at + 2] == "-" and pattern[at + 2 : at + 3] not in ("", "]"):
            out.append(f"{_escape(char)}-{_escape(pattern[at + 2])}")
            at += 3
        else:
            out.append(_escape(char))
            at += 1
    plain = [x for x in out if not x.startswith("[^")]
    inverse = [x for x in out if x.startswith("[^")]
    body = f"[{''.join(plain)}]" if plain else ""
    if inverse:
        both = "|".join([*([body] if body else []), *inverse])
        return (f"(?!{both})(?s:.)" if negated else f"(?:{both})"), at + 1
    return (f"[^{''.join(plain)}]" if negated else body), at + 1


@lru_cache(maxsize=4096)
def to_regex(pattern: str, unicode: bool = True) -> tuple[str, bool, list[bool]]:
    """(expression, needs recursion, for each capture whether it is a position)."""
    out, captures, open_, recursive, at = [], [], [], False, 0
    if pattern.startswith("^"):
        out.append("\\A")
        at = 1
    while at < len(pattern):
        char = pattern[at]
        if char == "(":
            if pattern[at + 1 : at + 2] == ")":
                captures.append(True)
                out.append("()")
                at += 2
            else:
                captures.append(False)
                open_.append(len(captures))
                out.append("(")
                at += 1
            continue
        if char == ")":
            if not open_:
                raise PatternError("invalid pattern capture")
            open_.pop()
            out.append(")")
            at += 1
            continue
        if char == "$" and at == len(pattern) - 1:
            out.append("\\z")
            at += 1
            continue
        if char == "%":
            if at + 1 >= len(pattern):
                raise PatternError("malformed pattern (ends with '%')")
            name = pattern[at + 1]
            if name == "b":
                left, right = pattern[at + 2 : at + 3], pattern[at + 3 : at + 4]
                if not right:
                    raise PatternError("missing arguments to '%b'")
                recursive = True
                group = f"b{at}"
                out.append(f"(?<{group}>{_escape(left)}(?:[^{_escape(left)}{_escape(right)}]|(?&{group}))*+{_escape(right)})" if left != right else f"{_escape(left)}[^{_escape(left)}]*{_escape(right)}")
                captures.append(None) if left != right else None
                at += 4
                continue
            if name == "f":
                if pattern[at + 2 : at + 3] != "[":
                    raise PatternError("missing '[' after '%f' in pattern")
                body, at = _set(pattern, at + 3, unicode)
                end = "|\\z" if body.startswith(("[^", "(?!")) else ""
                out.append(f"(?<!{body})(?={body}{end})" if not body.startswith("(?!") else f"(?={body}{end})")
                continue
            if name.isdigit() and name != "0":
                out.append(f"\\{name}")
                at += 2
                continue
            kind = CLASSES[unicode].get(name.lower()) if name.isalpha() else None
            one, at = (f"[^{kind}]" if name.isupper() else f"[{kind}]") if kind else _escape(name), at + 2
        elif char == "[":
            one, at = _set(pattern, at + 1, unicode)
        elif char == ".":
            one, at = "(?s:.)", at + 1
        else:
            one, at = _escape(char), at + 1
        follow = pattern[at : at + 1]
        if follow and follow in "*+?-":
            if one.startswith("(?!"):
                one = f"(?:{one})"
            out.append(one + {"*": "*", "+": "+", "?": "?", "-": "*?"}[follow])
            at += 1
        else:
            out.append(one)
    if open_:
        raise PatternError("unfinished capture")
    return "".join(out), recursive, captures


@lru_cache(maxsize=1024)
def compiled(pattern: str, unicode: bool = True):
    expression, _, captures = to_regex(pattern, unicode)
    return regex.compile(expression.replace("\\z", "\\Z")), captures


def _groups(m, captures) -> list[str]:
    """The captures as text; a position capture as its number; the whole match if there is none."""
    named = {i for i, c in enumerate(captures, 1) if c is None}
    got = [str(m.start(i) + 1) if position else m[i] for i, position in enumerate(captures, 1) if i not in named]
    return got or [m[0]]


def find(text: str, pattern: str, start: int = 1, unicode: bool = True) -> tuple[int, int, list[str]] | None:
    """(first, last, captures), positions from 1; null if nothing matches."""
    expression, captures = compiled(pattern, unicode)
    begin = max(start - 1, 0) if start > 0 else max(len(text) + start, 0) if start else 0
    m = expression.search(text, begin)
    return (m.start() + 1, m.end(), [] if not [c for c in captures if c is not None] else _groups(m, captures)) if m else None


def match(text: str, pattern: str, unicode: bool = True) -> list[str] | None:
    expression, captures = compiled(pattern, unicode)
    m = expression.search(text)
    return _groups(m, captures) if m else None


def gmatch(text: str, pattern: str, unicode: bool = True) -> list[list[str]]:
    expression, captures = compiled(pattern, unicode)
    return [_groups(m, captures) for m in expression.finditer(text)]


def gsub(text: str, pattern: str, replacement: str | dict, limit: int | None = None, unicode: bool = True) -> str:
    """Replaces up to ``limit`` matches by text (``%0``-``%9``, ``%%``) or by a table of the first capture."""
    expression, captures = compiled(pattern, unicode)

    def one(m) -> str:
        groups = _groups(m, captures)
        if isinstance(replacement, dict):
            return str(replacement.get(groups[0], m[0]))

        def part(p) -> str:
            if p[1] == "%":
                return "%"
            if p[1] == "0":
                return m[0]
            place = int(p[1]) - 1
            if place >= len(groups):
                raise PatternError("invalid capture index")
            return groups[place] or ""

        return regex.sub(r"%([0-9%])", part, replacement)

    if limit is not None and limit < 1:
        return text
    return expression.sub(one, text, count=limit or 0)


# columns


def match_column(x, pattern: str, unicode: bool = True) -> Column:
    """The first capture (or the whole match) of the first match, null if there is none."""
    expression, recursive, captures = to_regex(pattern, unicode)
    if recursive or any(captures):
        return mapped(lambda t: (match(t, pattern, unicode) or [None])[0], "string", col(x))
    return F.when(col(x).rlike(expression), F.regexp_extract(col(x), expression, 1 if captures else 0))


def gmatch_column(x, pattern: str, unicode: bool = True) -> Column:
    """The first capture (or the whole match) of every match."""
    expression, recursive, captures = to_regex(pattern, unicode)
    if recursive or any(captures):
        return mapped(lambda t: [g[0] for g in gmatch(t, pattern, unicode)], "array<string>", col(x))
    return F.regexp_extract_all(col(x), F.lit(expression), 1 if captures else 0)


def gsub_column(x, pattern: str, replacement: str, limit: int | None = None, unicode: bool = True) -> Column:
    expression, recursive, captures = to_regex(pattern, unicode)
    if recursive or limit is not None or any(captures):
        return mapped(lambda t: gsub(t, pattern, replacement, limit, unicode), "string", col(x))
    plain = regex.sub(r"[\\$]", r"\\\g<0>", replacement)
    java = regex.sub(r"%([0-9%])", lambda m: "%" if m[1] == "%" else f"${m[1] if captures or m[1] == '0' else '0'}", plain)
    return F.regexp_replace(col(x), expression, java)


def find_column(x, pattern: str, start: int = 1, unicode: bool = True) -> Column:
    """(first, last) of the first match, null if there is none."""

    def one(text: str):
        found = find(text, pattern, start, unicode)
        return None if found is None else {"first": found[0], "last": found[1]}

    return mapped(one, "struct<first:int,last:int>", col(x))
