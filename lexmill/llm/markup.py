"""Markup residue in text documents (problem 1).

Wikitext, HTML, Markdown and LaTeX are read into one kind of tree. Composite
text density (characters per tag, adjusted for link text) is computed for every
node, child densities are summed, and the subtree with the greatest sum is the
content; the least density on its way up to the body is the threshold below
which containers that are mostly links, at any depth, are left out. The tree is
then written as clean text in which headings, lists, tables, code blocks and
formulas can be told apart. Trees of any depth are walked without recursion, and
every pattern fails in time linear in the text.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from html.entities import html5

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.session import table

ELEMENTS = ("heading", "list", "table", "code", "formula", "inline")

# Tags that make up the named elements; other known tags are inline.
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
LISTS = {"ul", "ol", "dl", "li", "dt", "dd"}
TABLES = {"table", "caption", "thead", "tbody", "tfoot", "tr", "td", "th", "col", "colgroup"}
OTHER_TAGS = set(
    "a abbr address article aside b bdi bdo big blockquote body br center cite code data del details dfn div em figcaption figure font footer gallery head header hr html i img includeonly"
    " input ins kbd label link main mark meta nav noinclude nowiki onlyinclude p poem q rb ref references rp rt ruby s samp script section small span strike strong style sub summary sup time title tt u var wbr".split()
)
VOID = {"br", "hr", "img", "wbr", "col", "input", "link", "meta"}
BLOCKS = HEADINGS | LISTS | TABLES | {"p", "div", "blockquote", "section", "article", "header", "footer", "nav", "main", "aside", "center", "html", "head", "title", "body", "pre", "display"}
#: Blocks that are marked in the clean text.
SOLID = HEADINGS | LISTS | TABLES | {"pre", "display"}
#: Blocks that only hold others; one that is mostly links can be a menu.
CONTAINERS = {"div", "section", "header", "footer", "nav", "aside", "center", "article", "main"}
#: Deeper list items are indented like those of this depth.
MAX_INDENT = 40
# An opening tag ends an open tag of these kinds, up to the container.
ENDS = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"})}
# Environments of LaTeX.
TEX_LISTS = {"itemize": "ul", "enumerate": "ol", "description": "dl"}
TEX_TABLES = {"tabular", "tabular*", "tabularx", "longtable", "array", "table", "table*"}
TEX_SECTIONS = {"part": 1, "chapter": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 5, "subparagraph": 6}


class Node:
    """An element of the tree; kids are nodes and texts."""

    __slots__ = ("tag", "kids", "chars", "tags", "link_chars", "link_tags", "density", "total", "blocks", "solid", "dropped")

    def __init__(self, tag: str):
        self.tag, self.kids = tag, []
        self.blocks = self.solid = self.dropped = False


class Builder:
    """Builds a tree from opening and closing tags that need not match."""

    def __init__(self):
        self.root = Node("body")
        self.stack = [self.root]
        self.found: set[str] = set()
        self.opened: Counter[str] = Counter()

    def _leave(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.opened[self.stack.pop().tag] -= 1

    def _enter(self, node: Node) -> None:
        self.stack.append(node)
        self.opened[node.tag] += 1

    def open(self, tag: str) -> None:
        ends = ENDS.get(tag)
        if ends and any(self.opened[x] for x in ends[0]):
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag in ends[0]:
                    self._leave(i)
                    break
                if self.stack[i].tag in ends[1]:
                    break
        elif not ends and tag in BLOCKS and self.stack[-1].tag == "p":
            self._leave(len(self.stack) - 1)
        node = Node(tag)
        self.stack[-1].kids.append(node)
        if tag not in VOID:
            self._enter(node)
        if tag in HEADINGS:
            self.found.add("heading")
        elif tag in LISTS:
            self.found.add("list")
        elif tag in TABLES:
            self.found.add("table")

    def close(self, tag: str) -> None:
        if self.opened[tag]:
            i = len(self.stack) - 1
            while self.stack[i].tag != tag:
                i -= 1
            self._leave(i)

    def leaf(self, tag: str, text: str) -> None:
        if tag in BLOCKS and self.stack[-1].tag == "p":
            self._leave(len(self.stack) - 1)
        node = Node(tag)
        node.kids.append(text)
        self.stack[-1].kids.append(node)

    def code(self, text: str) -> None:
        self.found.add("code")
        self.leaf("pre", text)

    def formula(self, text: str, display: bool = False) -> None:
        self.found.add("formula")
        self.leaf("display" if display else "math", text)

    def text(self, text: str) -> None:
        if text:
            self.stack[-1].kids.append(text)

    def inline(self) -> None:
        self.found.add("inline")

    def paragraph(self) -> None:
        """A blank line: the next text begins a new paragraph."""
        if self.stack[-1].tag == "p":
            self._leave(len(self.stack) - 1)
        if self.stack[-1] is self.root:
            self._enter(Node("p"))
            self.root.kids.append(self.stack[-1])


class Closers:
    """Where an opened region ends. A closer that is not found once is not there for any later opener."""

    def __init__(self, text: str):
        self.text, self.gone = text, set()

    def find(self, closer: str | re.Pattern, at: int) -> tuple[int, int] | None:
        """(begin, end) of the first closer from ``at``."""
        if closer in self.gone:
            return None
        if isinstance(closer, str):
            begin = self.text.find(closer, at)
            if begin >= 0:
                return begin, begin + len(closer)
        elif m := closer.search(self.text, at):
            return m.span()
        self.gone.add(closer)
        return None


def _regions(text: str, opener: re.Pattern, closer_of: Callable, put: Callable) -> str:
    """text with each region from an opener to its closer replaced by put(opener, body).

    closer_of(opener) is the closer; null leaves the opener as it is, "" makes a
    region of the opener alone, and a comment without an end goes to the end of the text.
    """
    closers, out, done, at = Closers(text), [], 0, 0
    while m := opener.search(text, at):
        at, closer = m.end(), closer_of(m)
        if closer is None:
            continue
        place = (at, at) if closer == "" else closers.find(closer, at)
        if place is None and m[0] == "<!--":
            place = (len(text), len(text))
        if place is None:
            continue
        out += [text[done : m.start()], put(m, text[at : place[0]])]
        done = at = place[1]
    return "".join([*out, text[done:]])


_CLOSING = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in ("pre", "syntaxhighlight", "source", "nowiki", "math", "ref", "code", "script", "style", "span")}


# ---- which markup -----------------------------------------------------------

_LINES = re.compile(r"\r\n|\n|\r")
_HIDDEN = re.compile(
    r"<!--|<(?P<tag>pre|syntaxhighlight|source|nowiki|math|ref|code)\b[^<>]*(?<!/)>|^(?P<fence>```++|~~~++)[^\n]*\n|\\begin\{(?P<raw>verbatim|lstlisting)\}|`[^`\n]+`",
    re.M | re.I,
)
_TEX = re.compile(r"\\(?:begin|end|part|chapter|(?:sub)*section|(?:sub)?paragraph|text(?:bf|it|sc|tt|rm)|emph|footnote|ref|cite|label|item|href|url)\*?(?=[\[{\s])|\\verb\W|\{\\(?:bf|it|em|tt|sc)\s|\\['`^\"~=.]\{?\w|\\[(\[](?!\*)|\\%")
_WIKI = re.compile(r"^={1,6}[^=\n].*?=[ \t\r]*$|\[\[[^\[\]\n]+\]\]|\{\{|^\{\||'''?|\[https?://[^\[\]\n]+\]|^(?:[*#]+[^\s*#]|[*#]+:|;\s*\S)|<(?:ref|nowiki)\b|__[A-Z]{3,}__", re.M)
_MARK = re.compile(
    r"^#{1,6}[ \t]+[^\n]*[^\s.!?;:,][ \t\r]*$|^[^\S\n]*+\S[^\n]*+\n(?:={3,}|-{2,})[ \t\r]*$|^\|?[ \t]*:?-{2,}:?[ \t]*\|[-:| \t]*$|^[ \t]{0,3}[-+][ \t]+\S|^[ \t]{0,3}\d+\.[ \t]+\S|\]\((?:[^()\n]|\([^()\n]*\))*+\)|\*\*[^\s*][^*\n]*\*\*|~~[^~\n]+~~|\\[*_`#\[]|^\$\$|<https?://[^<>\s]+>|(?<![\w*\\])\*[^\s*][^*\n]*\*(?![\w*])|(?<![\w_])__?[^\s_][^_\n]*[^\s_]__?(?![\w_])|(?:\A|\n[ \t]*\r?\n) {4}\S",
    re.M,
)
_SIGNS = re.compile(r"[<>\[\]{}|\\*#=`~$_&;+'-]|^[ \t]*\d+\.[ \t]|^ {4}", re.M)
_HIDES = re.compile(r"<[!A-Za-z]|```|~~~|\\begin\{|`")
_MATH_SPAN = re.compile(r"<span\s+class=.?math", re.I)
_INDENTED = re.compile(r"(?:\A|\n[ \t]*\r?\n)(?: {4}[^\n]*(?:\n|\Z))+")
_WIKI_TAG = re.compile(r"<(?:pre|ref|nowiki|syntaxhighlight|source|math)\b", re.I)
_FENCED = re.compile(r"^(?:```|~~~)", re.M)
_TICKED = re.compile(r"`[^`\n]+`")
_DOLLARS = re.compile(r"\$(?=[^\s$])(?=[^$\n]*[\\^_={])[^$\n]*+(?<=[^\s$])\$(?!\d)")
_TAGGED = re.compile(r"</?(?:p|ul|ol|li|h[1-6]|table|tr|td|span|b|i|em|pre|code|a)\b[^<>]*>", re.I)


def markup_of(source: str, hint: str | None = None) -> str:
    """wikitext (HTML is read with it), markdown or latex.

    The source decides by the constructs only one of them has, outside of code
    and comments; the hint, which may be wrong, breaks ties.
    """
    if not _SIGNS.search(source):
        return "wikitext"
    bare = _regions(source, _HIDDEN, _hidden_closer, lambda m, _: "\n" if m["fence"] else " ") if _HIDES.search(source) else source
    tex = 0
    if "\\" in source and not _MATH_SPAN.search(source):
        tex = 2 * len(_TEX.findall(bare)) + 3 * ("\\begin{verbatim}" in source or "\\begin{lstlisting}" in source)
    # what an indented block holds tells nothing but that it is one
    open_text = _INDENTED.sub("\n\n", bare) if "    " in bare else bare
    wiki = 2 * len(_WIKI.findall(open_text))
    if "<" in source:
        wiki += len(_TAGGED.findall(open_text)) + 2 * bool(_WIKI_TAG.search(source))
    mark = 2 * len(_MARK.findall(bare)) + 3 * bool(_FENCED.search(source))
    if "`" in source and "``" not in source:
        mark += 2 * bool(_TICKED.search(source))
    best = max(tex, wiki, mark)
    if not best:
        # all that is left to tell is a formula between dollar signs
        return hint if hint in ("latex", "markdown") else "markdown" if "$" in source and _DOLLARS.search(source) else "wikitext"
    leaders = [k for k, v in (("wikitext", wiki), ("markdown", mark), ("latex", tex)) if v == best]
    return hint if hint in leaders else leaders[0]


def _hidden_closer(m: re.Match) -> str | re.Pattern:
    if m["tag"]:
        return _CLOSING[m["tag"].lower()]
    if m["fence"]:
        return re.compile(rf"^{m['fence']}[ \t\r]*$", re.M)
    if m["raw"]:
        return f"\\end{{{m['raw']}}}"
    return "-->" if m[0] == "<!--" else ""


# ---- wikitext and HTML ------------------------------------------------------

_PROTECTED = re.compile(
    r"<!--|<(?P<tag>pre|syntaxhighlight|source|nowiki|math|script|style)\b(?P<attrs>[^<>]*?)(?<!/)>|<(?P<span>span)\s[^<>]*class=[\"']?[^<>\"']*\bmath\b[^<>]*>", re.I
)
_MULTILINE_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_BRACES = re.compile(r"\{+|\}+")
_HELD = re.compile(r"\x00(\d+)\x00")
_WIKI_INLINE = re.compile(
    r"\x00(?P<held>\d+)\x00|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*)?/?>|&(?P<entity>#\d+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
    r"|(?P<quotes>'{2,})|\[\[(?P<link>[^\[\]\n]+)\]\]|\[(?P<url>(?:https?:|ftp:|mailto:)[^\s\[\]]+)[ \t]*(?P<label>[^\[\]\n]*)\]|(?P<switch>__[A-Z]{3,}__)|(?P<sign>~{3,5})(?!~)"
)
_LIST_MARK = re.compile(r"[*#:;]+")
_WIKI_LISTS = {"*": "ul", "#": "ol", ":": "dl"}


def _entity(name: str) -> str | None:
    if name[0] == "#" or name + ";" in html5:
        return html.unescape(f"&{name};")
    return None


def _wiki_inline(b: Builder, text: str, held: list[tuple[str, str]]) -> None:
    at = 0
    for m in _WIKI_INLINE.finditer(text):
        kind = m.lastgroup
        if m["held"] is not None:
            b.text(text[at : m.start()])
            _release(b, *held[int(m["held"])], held)
        elif m["name"] is not None:
            name = m["name"].lower()
            known = name in HEADINGS or name in LISTS or name in TABLES
            if not known and name not in OTHER_TAGS and name not in ("syntaxhighlight", "source", "pre", "math"):
                continue
            b.text(text[at : m.start()])
            if not known:
                b.inline()
            if m["close"]:
                b.close(name)
            else:
                b.open(name)
                if m[0].endswith("/>"):
                    b.close(name)
        elif m["entity"] is not None:
            value = _entity(m["entity"])
            if value is None:
                continue
            b.text(text[at : m.start()])
            b.inline()
            b.text(value)
        else:
            b.text(text[at : m.start()])
            b.inline()
            if kind == "link":
                target, _, label = m["link"].partition("|")
                if not target.lower().startswith(("category:", "file:", "image:")):
                    b.leaf("a", (label or target).lstrip(":"))
            elif kind in ("url", "label"):
                b.leaf("a", m["label"] or m["url"])
        at = m.end()
    b.text(text[at:])


def _release(b: Builder, kind: str, body: str, held: list[tuple[str, str]]) -> None:
    if kind == "code":
        b.code(body)
    elif kind in ("formula", "display"):
        b.formula(body, kind == "display")
    else:
        b.inline()
        # what a template shows may hold what other templates show
        waiting = [body]
        while waiting:
            text = waiting.pop()
            m = _HELD.search(text)
            b.text(text[: m.start()] if m else text)
            if m:
                waiting += [text[m.end() :], held[int(m[1])][1]]


def _untagged(text: str) -> str:
    return html.unescape(re.sub(r"</?[A-Za-z][^<>]*>", "", text))


def _templates(text: str, hold: Callable[[str, str], str]) -> str:
    """text with every balanced template or parameter held; it shows its last unnamed argument.

    Inner ones come first; one with a single brace of its own in it is none.
    """
    frames: list[list] = [[0, [], False]]  # braces, pieces, whether a single brace is among them
    at = 0

    def literal(piece: str, broken: bool) -> None:
        frames[-1][1].append(piece)
        frames[-1][2] |= broken

    for m in _BRACES.finditer(text):
        frames[-1][1].append(text[at : m.start()])
        at, n = m.end(), len(m[0])
        if m[0][0] == "{":
            if n == 1:
                literal("{", True)
            else:
                frames.append([n, [], False])
            continue
        while n >= 2 and len(frames) > 1:
            opened, pieces, broken = frames.pop()
            if broken:
                literal("{" * opened, True)
                frames[-1][1] += pieces
                continue
            take = 3 if opened >= 3 and n >= 3 else 2
            shown = [p for p in "".join(pieces).split("|")[1:] if "=" not in p and p.strip()]
            mark = hold("inline", shown[-1].strip() if shown else "")
            opened, n = opened - take, n - take
            if opened >= 2:
                frames.append([opened, [mark], False])
            else:
                literal("{" * opened + mark, bool(opened))
        if n:
            literal("}" * n, True)
    frames[-1][1].append(text[at:])
    return "".join(x for opened, pieces, _ in frames for x in ["{" * opened, *pieces])


def _heading(line: str) -> tuple[int, str] | None:
    """(level, title) of a line of wikitext; comments may follow the closing signs."""
    text = line.rstrip(" \t")
    while text.endswith("\x00") and text[(begin := text.rfind("\x00", 0, -1)) + 1 : -1].isdigit():
        text = text[:begin].rstrip(" \t")
    left, right = min(len(text) - len(text.lstrip("=")), 6), min(len(text) - len(text.rstrip("=")), 6)
    inner = text[left : len(text) - right]
    if not left or not right or not inner.strip("= \t"):
        return None
    level = min(left, right)
    # signs beyond the shorter run belong to the title
    return level, ("=" * (left - level) + inner + "=" * (right - level)).strip()


def read_wikitext(source: str) -> Builder:
    """Wikitext with HTML in it, or plain HTML."""
    held: list[tuple[str, str]] = []

    def hold(kind: str, body: str) -> str:
        held.append((kind, body))
        return f"\x00{len(held) - 1}\x00"

    def closer(m: re.Match) -> str | re.Pattern:
        return "-->" if m[0] == "<!--" else _CLOSING[(m["tag"] or m["span"]).lower()]

    def protect(m: re.Match, body: str) -> str:
        if m[0] == "<!--":
            return hold("inline", "")
        if m["span"]:
            inner = body.strip()
            return hold("display" if inner.startswith("\\[") else "formula", re.sub(r"^\\[(\[]|\\[)\]]$", "", inner).strip())
        name = m["tag"].lower()
        if name == "math":
            return hold("display" if "block" in m["attrs"] else "formula", _untagged(body).strip())
        if name in ("script", "style"):
            return hold("formula" if "math/tex" in m["attrs"] else "inline", body if "math/tex" in m["attrs"] else "")
        if name == "nowiki":
            return hold("inline", html.unescape(body))
        return hold("code", _untagged(body).strip("\r\n"))

    text = source.replace("\x00", "")
    if "<" in text:
        text = _regions(text, _PROTECTED, closer, protect)
        text = _MULTILINE_TAG.sub(lambda m: _LINES.sub(" ", m[0]) if "\n" in m[0] or "\r" in m[0] else m[0], text)
    if "{{" in text:
        text = _templates(text, hold)
    b = Builder()
    tables, marks = 0, ""

    def leave_lists() -> None:
        nonlocal marks
        for mark in reversed(marks):
            b.close(_WIKI_LISTS[mark])
        marks = ""

    for line in _LINES.split(text):
        bare = line.strip()
        if not bare:
            leave_lists()
            b.paragraph()
            continue
        lead = bare[0]
        if lead not in "*#:;":
            leave_lists()
        if lead == "=" and (heading := _heading(bare)):
            b.paragraph()
            b.open(f"h{heading[0]}")
            _wiki_inline(b, heading[1], held)
            b.close(f"h{heading[0]}")
            continue
        if bare.startswith("{|"):
            tables += 1
            b.open("table")
            continue
        if tables and lead in "|!":
            if bare.startswith("|}"):
                tables -= 1
                b.close("table")
                _wiki_inline(b, bare[2:], held)
            elif bare.startswith("|-"):
                b.open("tr")
            elif bare.startswith("|+"):
                b.open("caption")
                _wiki_inline(b, bare[2:].strip(), held)
                b.close("caption")
            else:
                for cell in re.split(r"\|\||!!" if lead == "!" else r"\|\|", bare[1:]):
                    b.open("th" if lead == "!" else "td")
                    attrs, bar, rest = cell.partition("|")
                    _wiki_inline(b, (rest if bar and "=" in attrs and "[[" not in attrs else cell).strip(), held)
                    b.close("th" if lead == "!" else "td")
            continue
        if lead in "*#:;" and line[0] == lead and (m := _LIST_MARK.match(bare)) and m.end() < len(bare):
            now = m[0].replace(";", ":")
            if not marks:
                b.paragraph()
            same = 0
            while same < min(len(marks), len(now)) and marks[same] == now[same]:
                same += 1
            for mark in reversed(marks[same:]):
                b.close(_WIKI_LISTS[mark])
            for n, mark in enumerate(now[same:], same + 1):
                b.open(_WIKI_LISTS[mark])
                if n < len(now):
                    b.open("dd" if mark == ":" else "li")
            marks = now
            b.open({"*": "li", "#": "li", ":": "dd", ";": "dt"}[m[0][-1]])
            rest = bare[m.end() :].strip()
            if m[0][-1] == ";" and " : " in rest:
                term, _, rest = rest.partition(" : ")
                _wiki_inline(b, term, held)
                b.open("dd")
            _wiki_inline(b, rest, held)
            continue
        leave_lists()
        if len(b.stack) == 1:
            b.paragraph()
        _wiki_inline(b, line, held)
        b.text("\n")
    return b


# ---- Markdown ---------------------------------------------------------------

_FENCE = re.compile(r" {0,3}(`{3,}|~{3,})")
_ATX = re.compile(r" {0,3}(#{1,6})(?=[ \t]|$)")
_BULLET = re.compile(r"[ \t]*(?:([-*+])|(\d{1,9})[.)])[ \t]+(?:\[[ xX]\][ \t]+)?(?=\S)")
_RULE_ROW = re.compile(r"\|?[ \t]*:?-{2,}:?[ \t]*+(?:\|[ \t]*+:?-{2,}+:?[ \t]*+)*+\|?[ \t]*$")
_TEX_SPAN = re.compile(r"\$\$|\\\[|\\\(")
_PRE_OR_MATH = re.compile(r"<!--|<(?P<tag>pre|math)\b[^<>]*>", re.I)
_MARK_INLINE = re.compile(
    r"\x00(?P<held>\d+)\x00|(?P<escape>\\[\\`*_{}\[\]()#+\-.!~|<>$])|(?P<ticks>(?<!`)`++)(?P<code>[^`\n]++(?:(?!(?P=ticks)(?!`))`++[^`\n]++)*)(?P=ticks)(?!`)|(?P<image>!)?\[(?P<label>[^\[\]\n]*)\]\((?P<url>[^()\n]*(?:\([^()\n]*\)[^()\n]*)*)\)"
    r"|<(?P<auto>(?:https?:|mailto:)[^<>\s]+)>|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*)?/?>|&(?P<entity>#\d+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"
    r"|\$(?P<math>(?=[^\s$])[^$\n]*?(?<=[^\s$]))\$(?!\d)|(?P<stars>\*{1,3})(?=[^\s*])(?P<strong>[^*\n]*?(?<=[^\s*]))(?P=stars)(?!\*)|(?<![\w_])(?P<lows>_{1,3})(?=[^\s_])(?P<emph>(?:[^_\n]|(?<=\w)_++(?=\w))*(?<=[^\s_]))(?P=lows)(?![\w_])"
    r"|~~(?P<gone>[^~\n]+)~~|\[\^(?P<note>[^\]\s]+)\]"
)


def _mark_inline(b: Builder, text: str, held: list[tuple[str, str]]) -> None:
    at = 0
    for m in _MARK_INLINE.finditer(text):
        if m["held"] is not None:
            b.text(text[at : m.start()])
            _release(b, *held[int(m["held"])], held)
            at = m.end()
            continue
        if m["name"] is not None:
            name = m["name"].lower()
            known = name in HEADINGS or name in LISTS or name in TABLES
            if not known and name not in OTHER_TAGS:
                continue
            b.text(text[at : m.start()])
            if not known:
                b.inline()
            b.close(name) if m["close"] else b.open(name)
            at = m.end()
            continue
        if m["entity"] is not None and _entity(m["entity"]) is None:
            continue
        b.text(text[at : m.start()])
        at = m.end()
        if m["math"] is not None:
            b.formula(m["math"])
            continue
        b.inline()
        if m["escape"]:
            b.text(m["escape"][1])
        elif m["code"] is not None:
            b.leaf("code", m["code"])
        elif m["url"] is not None:
            b.text(m["label"]) if m["image"] else b.leaf("a", m["label"] or m["url"])
        elif m["auto"]:
            b.leaf("a", m["auto"])
        elif m["entity"] is not None:
            b.text(_entity(m["entity"]))
        elif m["stars"] or m["lows"]:
            _mark_inline(b, m["strong"] if m["stars"] else m["emph"], held)
        elif m["gone"]:
            b.text(m["gone"])
    b.text(text[at:])


def _tex_spans(text: str, hold: Callable[[str, str], str]) -> str:
    """text with ``$$ $$``, ``\\[ \\]`` (on one line, without other brackets) and ``\\( \\)`` held as formulas."""
    closers, out, done, at = Closers(text), [], 0, 0
    while m := _TEX_SPAN.search(text, at):
        at = m.end()
        place = closers.find({"$$": "$$", "\\[": "\\]", "\\(": "\\)"}[m[0]], at + 1)
        if place is None or (m[0] == "\\[" and re.search(r"[\]\n]", text[at : place[0]])):
            continue
        out += [text[done : m.start()], hold("formula" if m[0] == "\\(" else "display", text[at : place[0]].strip())]
        done = at = place[1]
    return "".join([*out, text[done:]])


def read_markdown(source: str) -> Builder:
    held: list[tuple[str, str]] = []

    def hold(kind: str, body: str) -> str:
        held.append((kind, body))
        return f"\x00{len(held) - 1}\x00"

    b = Builder()
    lines = _LINES.split(source.replace("\x00", ""))
    i, blank, fence = 0, True, None
    out: list[str | tuple[str, str]] = []
    # first pass: code, comments and displayed formulas, which nothing else may look into
    while i < len(lines):
        line = lines[i]
        if fence := _FENCE.match(line):
            body, i = [], i + 1
            while i < len(lines) and not re.match(rf" {{0,3}}{re.escape(fence[1])}[`~]*[ \t]*$", lines[i]):
                body.append(lines[i])
                i += 1
            out.append(("code", "\n".join(body)))
            blank = False
        elif line.startswith(("    ", "\t")) and line.strip() and blank and not (out and _near_list(out)):
            body = []
            while i < len(lines) and (lines[i].startswith(("    ", "\t")) or not lines[i].strip()):
                body.append(lines[i][4:] if lines[i].startswith("    ") else lines[i].lstrip("\t"))
                i += 1
            while body and not body[-1].strip():
                body.pop()
            out += [("code", "\n".join(body)), ""]
            i -= 1
            blank = True
        elif line.lstrip().startswith("$$"):
            body = line.lstrip()[2:]
            read = [body]
            while "$$" not in read[-1] and i + 1 < len(lines):
                i += 1
                read.append(lines[i])
            body, _, rest = "\n".join(read).partition("$$")
            out.append(("display", body.strip()))
            if rest.strip():
                out.append(rest)
            blank = False
        else:
            out.append(line)
            blank = not line.strip()
        i += 1
    joined = []
    for x in out:
        joined.append(f"{hold(*x)}" if isinstance(x, tuple) else x)
    text = "\n".join(joined)
    if "<" in text:
        kinds = {"pre": lambda body: hold("code", _untagged(body).strip("\n")), "math": lambda body: hold("formula", _untagged(body))}
        text = _regions(text, _PRE_OR_MATH, lambda m: _CLOSING[m["tag"].lower()] if m["tag"] else "-->", lambda m, body: kinds[m["tag"].lower()](body) if m["tag"] else hold("inline", ""))
    if "$$" in text or "\\[" in text or "\\(" in text:
        text = _tex_spans(text, hold)
    lines, i, open_list = text.split("\n"), 0, None

    def end_list() -> None:
        nonlocal open_list
        if open_list:
            b.close(open_list)
            open_list = None

    while i < len(lines):
        line = lines[i]
        bare = line.strip()
        if not bare:
            if not (open_list and i + 1 < len(lines) and _BULLET.match(lines[i + 1])):
                end_list()
            b.paragraph()
        elif m := _ATX.match(line):
            end_list()
            b.paragraph()
            b.open(f"h{len(m[1])}")
            title = line[m.end() :].strip(" \t")
            bare_title = title.rstrip("#")
            _mark_inline(b, bare_title.rstrip() if not bare_title or bare_title[-1] in " \t" else title, held)
            b.close(f"h{len(m[1])}")
        elif m := _BULLET.match(line):
            kind = "ul" if m[1] else "ol"
            if open_list != kind:
                end_list()
                b.paragraph()
                b.open(kind)
                open_list = kind
            b.open("li")
            _mark_inline(b, line[m.end() :], held)
        elif i + 1 < len(lines) and re.match(r" {0,3}(?:=+|-{2,})[ \t]*$", lines[i + 1]) and "|" not in lines[i + 1] and not bare.startswith("\x00"):
            end_list()
            b.paragraph()
            tag = "h1" if "=" in lines[i + 1] else "h2"
            b.open(tag)
            _mark_inline(b, bare, held)
            b.close(tag)
            i += 1
        elif "|" in bare and i + 1 < len(lines) and "|" in lines[i + 1] and _RULE_ROW.match(lines[i + 1].strip()):
            end_list()
            b.open("table")
            first = True
            while i < len(lines) and "|" in lines[i] and lines[i].strip():
                if not _RULE_ROW.match(lines[i].strip()):
                    b.open("tr")
                    for cell in re.split(r"(?<!\\)\|", lines[i].strip().strip("|")):
                        b.open("th" if first else "td")
                        _mark_inline(b, cell.strip(), held)
                    first = False
                i += 1
            b.close("table")
            i -= 1
        elif re.match(r" {0,3}(?:(?:\*[ \t]*){3,}|(?:-[ \t]*){3,}|(?:_[ \t]*){3,})$", line):
            end_list()
            b.inline()
            b.open("hr")
        else:
            if bare[0] == ">":
                b.inline()
                bare = bare.lstrip("> ")
            if not open_list and len(b.stack) == 1:
                b.paragraph()
            _mark_inline(b, bare, held)
            b.text("\n")
        i += 1
    return b


def _near_list(out: list) -> bool:
    """Whether the last text before blank lines is a list item: indented lines then go on with it."""
    for x in reversed(out):
        if isinstance(x, tuple):
            return False
        if x.strip():
            return bool(_BULLET.match(x)) and x.startswith(" ")
    return False


# ---- LaTeX ------------------------------------------------------------------

_TEX_TOKEN = re.compile(
    r"\\verb\*?(?P<mark>[^\w\s*])|(?P<dollars>\$\$)|(?P<square>\\\[)|(?P<round>\\\()|\$(?P<math>(?=[^\s$])[^$]*?(?<=[^\s$]))\$(?!\d)"
    r"|\\(?P<way>begin|end)\{(?P<what>[A-Za-z]+\*?)\}(?:\[[^\[\]\n]*\])?(?:\{[^{}\n]*\})?|\\(?P<section>part|chapter|(?:sub){0,2}section|(?:sub)?paragraph)\*?(?:\[[^\[\]\n]*\])?\{"
    r"|\\(?P<item>item)\b(?:\[(?P<term>[^\[\]\n]*)\])?|(?P<newline>\\\\)(?:\[[^\[\]\n]*\])?|(?P<comment>(?<![\\\d])%[^\n]*)|\\(?P<accent>['`^\"~=.])(?:\{(?P<base>\w)\}|(?P<base2>[A-Za-z]))"
    r"|\\(?P<drop>ref|cite[pt]?|label|pageref|index|usepackage|documentclass|vspace|hspace)\*?(?:\[[^\[\]\n]*\])?\{[^{}\n]*\}|\\(?P<command>text[a-z]{2}|emph|footnote|underline|href|url|caption|title|author|mbox|bf|it|em|tt|sc|rm|large|small|centering|hline|maketitle|par|noindent|ldots|LaTeX|TeX)(?![A-Za-z])\*?(?P<grab>\{)?"
    r"|\\(?P<sign>[%$&#_{}])|(?P<blank>\n[ \t]*+\n\s*)|(?P<open>\{)|(?P<shut>\})|(?P<amp>&)",
    re.S,
)
# Environments of LaTeX whose text is code, or a displayed formula.
TEX_CODE = {"verbatim", "verbatim*", "lstlisting", "minted", "Verbatim"}
TEX_DISPLAY = {x + star for x in ("equation", "align", "gather", "multline", "eqnarray", "displaymath", "math") for star in ("", "*")}
_TEX_OPTION = re.compile(r"\[[^\[\]]*\]")
# Combining marks of the accent commands.
TEX_ACCENTS = {"'": "́", "`": "̀", "^": "̂", '"': "̈", "~": "̃", "=": "̄", ".": "̇"}


def read_latex(source: str) -> Builder:
    import unicodedata

    b = Builder()
    text = _LINES.sub("\n", source)
    b.paragraph()
    at, groups, rows = 0, [], 0
    closers, look = Closers(text), 0
    while m := _TEX_TOKEN.search(text, look):
        kind, look = m.lastgroup, m.end()
        if kind in ("mark", "dollars", "square", "round"):
            place = closers.find({"dollars": "$$", "square": "\\]", "round": "\\)"}.get(kind) or m["mark"], look + (kind != "mark"))
            if place is None:
                if kind == "dollars":
                    look -= 1
                continue
            b.text(text[at : m.start()])
            body, at = text[look : place[0]], place[1]
            look = at
            if kind == "mark":
                b.inline()
                b.leaf("code", body)
            else:
                b.formula(body.strip(), kind != "round")
            continue
        if m["way"] == "begin" and (m["what"] in TEX_CODE or m["what"] in TEX_DISPLAY):
            start = m.end("what") + 1
            if m["what"] in TEX_CODE and (option := _TEX_OPTION.match(text, start)):
                start = option.end()
            if place := closers.find(f"\\end{{{m['what']}}}", start):
                b.text(text[at : m.start()])
                body, at = text[start : place[0]], place[1]
                look = at
                b.code(body.strip("\n")) if m["what"] in TEX_CODE else b.formula(body.strip(), True)
                continue
        if kind == "amp" and not rows:
            continue
        if kind == "open" and not groups and "\\" not in text[m.end() : m.end() + 4]:
            continue
        if kind == "shut" and not groups:
            continue
        b.text(text[at : m.start()])
        at = m.end()
        if kind == "math":
            b.formula(m["math"].strip())
        elif m["what"]:
            name = m["what"]
            if name in TEX_LISTS:
                b.open(TEX_LISTS[name]) if m["way"] == "begin" else b.close(TEX_LISTS[name])
            elif name in TEX_TABLES:
                if m["way"] == "begin":
                    rows += 1
                    b.open("table")
                    b.open("tr")
                    b.open("td")
                else:
                    rows = max(0, rows - 1)
                    b.close("table")
            else:
                b.inline()
        elif m["section"]:
            tag = f"h{TEX_SECTIONS[m['section']]}"
            b.paragraph()
            b.open(tag)
            groups.append(tag)
        elif m["item"]:
            b.open("li")
            if m["term"]:
                b.text(m["term"] + ": ")
        elif m["newline"]:
            if rows:
                b.open("tr")
                b.open("td")
            else:
                b.inline()
                b.text("\n")
        elif kind == "amp":
            b.open("td")
        elif kind == "comment":
            b.inline()
        elif m["accent"]:
            b.inline()
            b.text(unicodedata.normalize("NFC", (m["base"] or m["base2"]) + TEX_ACCENTS[m["accent"]]))
        elif m["drop"]:
            b.inline()
        elif m["command"]:
            if m["command"] != "hline":
                b.inline()
            if m["grab"]:
                groups.append("")
        elif kind == "sign":
            b.inline()
            b.text(m["sign"])
        elif kind == "blank":
            if b.stack[-1].tag == "p" or len(b.stack) == 1:
                b.paragraph()
            else:
                b.text(" ")
        elif kind == "open":
            groups.append("")
        elif kind == "shut":
            tag = groups.pop()
            if tag:
                b.close(tag)
    b.text(text[at:])
    return b


READERS = {"wikitext": read_wikitext, "markdown": read_markdown, "latex": read_latex}


# ---- composite text density -------------------------------------------------


def measure(root: Node) -> None:
    """chars, tags, link_chars, link_tags, density and total (sum of child densities) of every
    node, and whether it holds blocks or blocks that are marked."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [k for k in node.kids if k.__class__ is Node]
    for node in reversed(order):
        chars = tags = link_chars = link_tags = 0
        for kid in node.kids:
            if kid.__class__ is Node:
                chars += kid.chars
                tags += kid.tags + 1
                link_chars += kid.link_chars
                link_tags += kid.link_tags + (kid.tag == "a")
                node.blocks = node.blocks or kid.blocks or kid.tag in BLOCKS
                node.solid = node.solid or kid.solid or kid.tag in SOLID
            else:
                chars += len(kid.strip())
        node.chars, node.tags, node.link_tags = chars, tags, link_tags
        node.link_chars = chars if node.tag == "a" else link_chars
    body_ratio = root.link_chars / max(root.chars, 1)
    for node in reversed(order):
        c, t, lc, lt = node.chars, max(node.tags, 1), max(node.link_chars, 1), max(node.link_tags, 1)
        if c:
            base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + body_ratio * c + math.e)
            node.density = c / t * math.log(max(c / lc * (t / lt), 1)) / math.log(base + math.e - 1)
        else:
            node.density = 0.0
        node.total = sum(k.density for k in node.kids if k.__class__ is Node)


def content(root: Node) -> Node:
    """The tree with the nodes that are no content marked as dropped.

    The subtree of the greatest density sum, at any depth, is the content. The
    least density on its way up to the body is the threshold: a container off that
    way that is less dense and mostly links is dropped, as is the head of a page.
    Headings, lists, tables, code and formulas are sparse by nature and stay.
    """
    measure(root)
    above: dict[int, Node] = {}
    best, stack = root, [root]
    while stack:
        node = stack.pop()
        if node.total > best.total:
            best = node
        for kid in reversed(node.kids):
            if kid.__class__ is Node and (kid.blocks or kid.tag in BLOCKS):
                above[id(kid)] = node
                stack.append(kid)
    way, node = {id(root)}, best
    threshold = min(root.density, best.density)
    while node is not root:
        way.add(id(node))
        threshold = min(threshold, node.density)
        node = above[id(node)]
    stack = [root]
    while stack:
        for kid in stack.pop().kids:
            if kid.__class__ is Node:
                if kid.tag in ("head", "title") or (kid.tag in CONTAINERS and id(kid) not in way and kid.density < threshold and kid.link_chars * 2 > kid.chars):
                    kid.dropped = True
                elif kid.blocks:
                    stack.append(kid)
    return root


# ---- clean text -------------------------------------------------------------


def _flat(*nodes: Node | str) -> str:
    """The text of nodes without marks of blocks; blocks and line breaks part words."""
    out, stack = [], list(reversed(nodes))
    while stack:
        node = stack.pop()
        if node.__class__ is not Node:
            out.append(node)
        elif node.tag in ("math", "display"):
            out.append(f"${node.kids[0]}$")
        elif node.tag == "br":
            out.append("\n")
        elif node.tag != "ref" and not node.dropped:
            parted = [" "] if node.tag in BLOCKS else []
            stack += [*parted, *reversed(node.kids), *parted]
    return "".join(out)


def _words(text: str) -> str:
    return re.sub(r"[ \t\r\n]+", " ", text).strip()


class _Writer:
    """Writes a tree as text. The walks are generators that yield the walks into their
    children, so a deep tree needs no deep stack."""

    def __init__(self):
        self.out: list[list[str]] = []
        self.run: list[str] = []
        self.last: tuple[int, int] | None = None  # level and number of the item written last

    def written(self, root: Node) -> str:
        walks = [self.block(root, 0)]
        while walks:
            inner = next(walks[-1], None)
            if inner is None:
                walks.pop()
            else:
                walks.append(inner)
        self.flush()
        return "\n\n".join("\n".join(lines) for lines in self.out)

    def put(self, text: str) -> None:
        self.out.append([text])
        self.last = None

    def flush(self) -> None:
        text = "\n".join(x for x in (_words(x) for x in "".join(self.run).split("\n")) if x)
        self.run.clear()
        if text:
            self.put(text)

    def block(self, node: Node, level: int):
        """Headings as #, list items as - or 1., table rows with |, code in fences, formulas in $."""
        for kid in node.kids:
            if kid.__class__ is not Node:
                self.run.append(kid)
            elif kid.dropped or kid.tag == "ref":
                continue
            elif kid.tag == "math":
                self.run.append(f"${_words(kid.kids[0])}$")
            elif kid.tag == "br":
                self.run.append("\n")
            elif kid.tag not in BLOCKS:
                if kid.blocks:
                    yield self.block(kid, level)
                else:
                    self.run.append(_flat(kid))
            else:
                self.flush()
                if kid.tag in HEADINGS:
                    self.put(f"{'#' * int(kid.tag[1])} {_words(_flat(*kid.kids))}")
                elif kid.tag == "pre":
                    self.put(f"```\n{kid.kids[0]}\n```")
                elif kid.tag == "display":
                    self.put(f"$${_words(kid.kids[0])}$$")
                elif kid.tag in ("ul", "ol", "dl"):
                    yield self.items(kid, level)
                elif kid.tag in LISTS:
                    yield self.item(kid, ": " if kid.tag == "dd" else "- ", level, 0)
                elif kid.tag in TABLES:
                    self.rows(kid)
                else:
                    yield self.block(kid, level)
                    self.flush()

    def items(self, node: Node, level: int, nested: bool = False):
        # a list goes on with the one before it if both are numbered or neither is
        number = self.last[1] if node.tag == "ol" and self.last and self.last[0] == level else 0
        if not nested and self.last and (self.last[1] > 0) != (node.tag == "ol"):
            self.last = None
        for kid in node.kids:
            if kid.__class__ is not Node:
                self.run.append(kid)
                continue
            if kid.tag in LISTS:
                self.flush()
            if kid.tag in ("ul", "ol", "dl"):
                yield self.items(kid, level + 1, True)
            elif kid.tag in LISTS:
                number += 1
                mark = f"{number}. " if node.tag == "ol" else ": " if kid.tag == "dd" else "- "
                yield self.item(kid, mark, level, number if node.tag == "ol" else 0)
            else:
                holder = Node("span")
                holder.kids = [kid]
                yield self.block(holder, level)
        self.flush()

    def item(self, node: Node, mark: str, level: int, number: int):
        own = [k for k in node.kids if k.__class__ is not Node or not (k.tag in SOLID or k.solid)]
        text = _words(_flat(*own))
        if text:
            line = "  " * min(level, MAX_INDENT) + mark + text
            if self.last is None:
                self.out.append([line])
            else:
                self.out[-1].append(line)
            self.last = (level, number)
        rest = Node("span")
        for kid in node.kids:
            if kid.__class__ is Node and not kid.dropped and (kid.tag in SOLID or kid.solid):
                if kid.tag in ("ul", "ol", "dl"):
                    yield self.items(kid, level + 1, True)
                else:
                    rest.kids = [kid]
                    yield self.block(rest, level + 1)
        self.flush()

    def rows(self, node: Node) -> None:
        lines, loose, stack = [], [], [node]
        while stack:
            at = stack.pop()
            if at.tag == "tr":
                cells = [_words(_flat(c)) for c in at.kids if c.__class__ is Node and c.tag in ("td", "th")]
                if any(cells):
                    lines.append("| " + " | ".join(cells) + " |")
            elif at.tag in ("td", "th"):
                loose.append(_words(_flat(at)))
            elif at.tag == "caption":
                lines.append(_words(_flat(at)))
            else:
                stack += reversed([k for k in at.kids if k.__class__ is Node and not k.dropped])
        if any(loose):
            at = 1 if lines and not lines[0].startswith("|") else 0
            lines.insert(at, "| " + " | ".join(loose) + " |")
        lines = [x for x in lines if x]
        if lines:
            self.put("\n".join(lines))


def render(root: Node) -> str:
    """The clean text of a measured tree."""
    return _Writer().written(root)


def cleaned(source: str | None, hint: str | None = None) -> tuple[str | None, list[str], str | None]:
    """(clean text, elements in the order of ELEMENTS, markup) of a source; null gives (null, none, null)."""
    if source is None:
        return None, [], None
    kind = markup_of(source, hint)
    built = READERS[kind](source)
    return render(content(built.root)), [e for e in ELEMENTS if e in built.found], kind


def converted(sources: DataFrame) -> DataFrame:
    """(src_table, src_id, hint, source) -> (src_table, src_id, markup, elements, clean), one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [cleaned(s, h) for s, h in zip(batch.column(3).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            columns = [batch.column(0), batch.column(1), pa.array([d[2] for d in done], pa.string()), pa.array([d[1] for d in done], pa.list_(pa.string())), pa.array([d[0] for d in done], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["src_table", "src_id", "markup", "elements", "clean"])

    return sources.select("src_table", "src_id", "hint", "source").mapInArrow(run, "src_table string, src_id bigint, markup string, elements array<string>, clean string")


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct sources of both tables; a revision that is in several snapshots is read once."""
    pages = table(spark, sf_dir, "bundle_pages").select(F.lit("bundle_pages").alias("src_table"), F.col("revision_id").alias("src_id"), F.col("content_model").alias("hint"), "source")
    sent = table(spark, sf_dir, "bundle_expander").select(F.lit("bundle_expander").alias("src_table"), F.col("request_id").alias("src_id"), F.lit(None).cast("string").alias("hint"), "source")
    return pages.union(sent).where("source is not null and source <> ''").distinct()


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src_table, src_id, element)."""
    return converted(sources(spark, sf_dir)).select("src_table", "src_id", F.explode("elements").alias("element")).distinct()


def clean_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return converted(sources(spark, sf_dir)).withColumn("elements", F.array_join("elements", ","))
