"""Calls with an open place, read once and evaluated for many values.

``{{#expr: @ * 2}}`` is the same text for all rows but for the value at ``@``: its constructs
are found once, a row only evaluates them. The result is that of expanding the text with
the value in it. Constructs that cannot be prepared are expanded so for every value, and
so is the whole text for values that could be read as markup.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from lexmill.functions import expression
from lexmill.wikitext import expand, scan

#: Stands for the value while a text is read: a code point that is no character.
OPEN = expression.OPEN
#: Values that no construct around them can take for markup.
PLAIN = re.compile(r"[0-9A-Za-z.,:/+ -]{1,64}")
#: Constructs of a text that is prepared, so that no limit of an expansion can be met.
MOST = 256
#: Results that a function of one argument keeps.
FEW = 64
#: Functions that use their arguments by their values only.
BY_VALUE = {
    "#if", "#ifeq", "#switch", "#iferror", "#ifexist", "#ifexpr", "#expr", "#len", "#sub", "#titleparts", "lc", "uc", "lcfirst", "ucfirst", "padleft", "padright", "formatnum", "plural", "urlencode", "anchorencode", "ns", "nse", "localurl", "fullurl", "canonicalurl", "#time", "#formatdate", "#dateformat", "#language",
}

#: A text that is the same for all values, or the text of a value.
Node = str | Callable[[str], str]
_FAILURES = (expand.TemplateError, NotImplementedError, RecursionError)


class Unprepared(Exception):
    pass


def whole(text: str, context: expand.Context) -> str:
    """The text expanded; a failure becomes markup."""
    try:
        return expand.Expander(context).expand(expand.strip_comments(expand.own(text)))
    except _FAILURES as e:
        return expand.lua_error(str(e))


def prepared(text: str, context: expand.Context) -> Callable[[str], str]:
    """``whole`` of the text with a value at each OPEN, as a function of the value."""
    plain = None
    if "<" not in text and "{{{" not in text and text.count("{{") <= MOST:
        try:
            plain = _Reader(context).text(text)
        except _FAILURES:
            pass

    def one(value: str) -> str:
        if plain is not None and PLAIN.fullmatch(value):
            try:
                return plain if isinstance(plain, str) else plain(value)
            except _FAILURES:
                pass
        return whole(text.replace(OPEN, value), context)

    return one


class _Reader:
    def __init__(self, context: expand.Context):
        # functions by value ask it for its context only
        self.context, self.expander = context, expand.Expander(context)

    def text(self, text: str) -> Node:
        """As ``Expander.expand``."""
        if OPEN not in text:
            return expand.Expander(self.context).expand(text)
        parts, at = [], 0
        for start, end, _ in expand.outermost(text):
            parts += [_literal(text[at:start]), self._construct(text[start:end])]
            at = end
        return _joined([*parts, _literal(text[at:])])

    def _construct(self, source: str) -> Node:
        if OPEN not in source:
            return expand.Expander(self.context).expand(source)
        try:
            return self._call(source[2:-2])
        except (Unprepared, *_FAILURES):
            return lambda v: expand.Expander(self.context).expand(source.replace(OPEN, v))

    def _call(self, inner: str) -> Node:
        head, *args = scan.split_top(inner, "|")
        found = re.match(rf"([^:：{{\[{OPEN}]*)[:：]", head)
        word = found[1].strip().lower() if found else "subst"
        if word in ("subst", "safesubst"):
            raise Unprepared
        key = self.context.aliases.get(word, word).strip().lower()
        if key not in BY_VALUE:
            raise Unprepared
        rest = head[found.end() :]
        first, function, expander = self._trimmed(rest), expand.FUNCTIONS[key], self.expander
        nodes = [tuple(x if x is None else self._trimmed(x) for x in expand.case(a)) if key == "#switch" else self._trimmed(a) for a in args]

        def by_text(v: str) -> str:
            return function(expander, _of(first, v), nodes, lambda node: node if node.__class__ is str else node(v).strip())

        if not any(callable(x) for node in nodes for x in (node if key == "#switch" else [node])):
            by_text = _remembered(first, lambda text: function(expander, text, nodes, str))

        if key not in ("#expr", "#ifexpr") or (number := expression.prepared(rest)) is None:
            return by_text
        yes, no = (nodes[i] if i < len(nodes) else "" for i in (0, 1))

        def by_number(v: str) -> str:
            if not v.isdecimal():
                return by_text(v)
            try:
                result = number(float(v))
                return expression.shown(result) if key == "#expr" else _of(yes if result else no, v)
            except expression.ExpressionError as e:
                return expression.error_text(str(e))

        return by_number

    def _trimmed(self, text: str) -> Node:
        node = self.text(text)
        return node.strip() if isinstance(node, str) else node


def _remembered(first: Node, function: Callable[[str], str]) -> Node:
    """The function of the first argument; its results are kept as long as there are few."""
    known: dict[str, str] = {}

    def by_first(v: str) -> str:
        text = _of(first, v)
        if (done := known.get(text)) is None:
            done = function(text)
            if len(known) < FEW:
                known[text] = done
        return done

    return by_first


def _of(node: Node, v: str) -> str:
    return node if node.__class__ is str else node(v).strip()


def _literal(text: str) -> Node:
    if OPEN not in text:
        return text
    pieces = text.split(OPEN)
    return lambda v: v.join(pieces)


def _joined(parts: list[Node]) -> Node:
    parts = [p for p in parts if p != ""]
    if all(isinstance(p, str) for p in parts):
        return "".join(parts)
    if len(parts) == 1:
        return parts[0]
    return lambda v: "".join([p if p.__class__ is str else p(v) for p in parts])
