"""Delimiters, tags, headings, lines and sections of wikitext."""

from __future__ import annotations

import html
import re

OPAQUE = ("nowiki", "pre", "math", "syntaxhighlight", "source", "score", "hiero", "timeline", "templatedata")
_OPAQUE = re.compile(rf"<!--.*?(?:-->|\Z)|<({'|'.join(OPAQUE)})\b[^<>]*?(?:/>|>.*?(?:</\1\s*>|\Z))", re.S | re.I)
#: Nesting of braces and brackets from which references count as dynamic.
MAX_DEPTH = 128


def opaque_spans(text: str) -> list[tuple[int, int]]:
    """The places of comments and of tags whose content is no wikitext."""
    return [m.span() for m in _OPAQUE.finditer(text)] if "<" in text else []


_DELIMITER = re.compile(r"\{\{+|\}\}+|\[\[|\]\]")


def pairs(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all balanced ``{{{``, ``{{`` and ``[[`` constructs, inner ones first.

    Opaque regions are skipped; nesting is followed to any depth.
    Of a run of opening braces three make a parameter if three close it.
    """
    skip = iter([*opaque_spans(text), (len(text) + 1, len(text) + 1)])
    low, high = next(skip)
    stack: list[list] = []
    opened = {"{": 0, "[": 0}
    out = []
    for m in _DELIMITER.finditer(text):
        while m.start() >= high:
            low, high = next(skip)
        if low <= m.start() < high:
            continue
        run = m[0]
        if run[0] == "{" or run == "[[":
            stack.append([m.start(), len(run), run[0]])
            opened[run[0]] += 1
            continue
        left = len(run)
        at = m.start()
        while left >= 2 and stack:
            start, n, kind = stack[-1]
            if kind != ("{" if run[0] == "}" else "["):
                # an unclosed construct of the other kind is only text
                if not opened["{" if run[0] == "}" else "["]:
                    break
                opened[stack.pop()[2]] -= 1
                continue
            take = 2 if kind == "[" else 3 if n >= 3 and left >= 3 else 2
            stack[-1][1] -= take
            at += take
            left -= take
            out.append((start + stack[-1][1], at, "[[" if kind == "[" else "{" * take))
            if stack[-1][1] < 2:
                opened[stack.pop()[2]] -= 1
    return out


def balanced(text: str, start: int) -> tuple[int, int, str] | None:
    """The construct that begins at start."""
    found = [p for p in pairs(text) if p[0] == start]
    return max(found, key=lambda p: p[1]) if found else None


def split_top(text: str, mark: str) -> list[str]:
    """Parts between marks that stand outside of nested constructs and opaque regions."""
    if mark not in text:
        return [text]
    inside = [(s, e) for s, e, _ in pairs(text)] + opaque_spans(text)
    inside = sorted(inside)
    out, last, cover, i = [], 0, -1, 0
    for m in re.finditer(re.escape(mark), text):
        while i < len(inside) and inside[i][0] <= m.start():
            cover = max(cover, inside[i][1])
            i += 1
        if m.start() >= cover:
            out.append(text[last : m.start()])
            last = m.end()
    out.append(text[last:])
    return out


def first_top(text: str, mark: str) -> int:
    """The place of the first mark outside of nested constructs, -1 if there is none."""
    parts = split_top(text, mark)
    return len(parts[0]) if len(parts) > 1 else -1


# tags

_TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9-]*)((?:\s+[^<>]*?)?)\s*(/?)>")
_ATTRIBUTE = re.compile(r"""([A-Za-z_:][\w:.-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'<>=]+)))?""")


def tag_parse(text: str, at: int = 0) -> dict | None:
    """name, attributes, closing, self_closing and end of the tag at a place."""
    m = _TAG.match(text, at)
    if not m:
        return None
    return {"name": m[2].lower(), "attributes": attributes(m[3]), "closing": bool(m[1]), "self_closing": bool(m[4]), "end": m.end()}


def attributes(text: str) -> dict[str, str]:
    """The first value of each attribute; one without a value is empty."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), html.unescape(next((g for g in m.groups()[1:] if g is not None), "")))
    return out


def matching_tag(text: str, start: int) -> tuple[int, int] | None:
    """Begin and end of the closing tag for the opening tag at start, nesting counted."""
    first = tag_parse(text, start)
    if not first or first["closing"] or first["self_closing"]:
        return None
    depth, at = 1, first["end"]
    for m in _TAG.finditer(text, at):
        if m[2].lower() != first["name"] or m[4]:
            continue
        depth += -1 if m[1] else 1
        if not depth:
            return m.span()
    return None


def line_break(text: str) -> bool:
    return bool(re.fullmatch(r"</?br\s*/?>|<br\s+[^<>]*>", text.strip(), re.I))


# headings, lines, sections

_HEADING = re.compile(r"^(=+)(.*?)(=+)[ \t]*(?:<!--.*?-->[ \t]*)*$")


def heading(line: str) -> tuple[int, str] | None:
    """(level, title): the shorter run of signs, six at most; signs beyond it stay in the title."""
    bare = re.sub(r"(?:[ \t]*<!--.*?-->)+[ \t]*$", "", line).rstrip()
    if len(bare) < 3 or bare[0] != "=" or bare[-1] != "=":
        return None
    left = len(bare) - len(bare.lstrip("="))
    right = len(bare) - len(bare.rstrip("="))
    if left == len(bare):
        left = right = (len(bare) - 1) // 2
    level = min(left, right, 6)
    title = bare[level : len(bare) - level].strip()
    return (level, title) if title else None


# Headings of parts of speech and of optional sections.
PARTS_OF_SPEECH = (
    "Adjective", "Adverb", "Ambiposition", "Article", "Circumposition", "Classifier", "Conjunction", "Contraction", "Counter", "Determiner", "Ideophone", "Interjection", "Noun", "Numeral",
    "Participle", "Particle", "Postposition", "Preposition", "Pronoun", "Proper noun", "Verb", "Circumfix", "Combining form", "Infix", "Interfix", "Prefix", "Root", "Suffix", "Diacritical mark",
    "Letter", "Ligature", "Number", "Punctuation mark", "Syllable", "Symbol", "Phrase", "Proverb", "Prepositional phrase", "Han character", "Hanzi", "Kanji", "Hanja", "Romanization", "Logogram", "Determinative",
)
SECTION_KINDS = {
    "etymology": ("Etymology",),
    "translations": ("Translations",),
    "references": ("References", "Further reading"),
    "quotations": ("Quotations",),
    "relations": ("Derived terms", "Related terms", "Descendants", "Synonyms", "Antonyms", "Hyponyms", "Hypernyms", "Holonyms", "Meronyms", "Coordinate terms", "Troponyms", "Anagrams", "See also"),
}

# line kinds by the signs that open a line
_PREFIX = re.compile(r"[#*:;]+")


def classify_line(line: str) -> tuple[str, int, str]:
    """(kind, depth, body) of a line."""
    m = _PREFIX.match(line)
    if not m:
        return ("paragraph" if line.strip() else "blank"), 0, line.lstrip()
    prefix, body = m[0], line[m.end() :].lstrip()
    depth = min(len(prefix), 255)
    last = prefix[-1]
    if prefix[0] == "#" and last == "#":
        return "definition", depth, body
    if prefix[0] == "#":
        return ("example" if last == ":" else "quotation" if last == "*" else "list_detail"), depth, body
    if last == "*" or last == "#":
        return "list_item", depth, body
    if last == ";":
        return "term", depth, body
    return ("list_detail" if "*" in prefix else "indent"), depth, body


def sections(source: str, levels: tuple[int, ...] = (1, 2)) -> list[tuple[int, int, str, str]]:
    """(ord, level, heading, source) of the sections a heading of these levels starts.

    The level met first is the boundary from then on. Headings in comments and
    opaque tags start nothing; text before the first heading is section 0 with
    an empty heading, if there is any.
    """
    hidden = opaque_spans(source)
    starts, boundary, at = [], None, 0
    for line in source.splitlines(keepends=True):
        found = heading(line.rstrip("\r\n")) if line.startswith("=") and not any(s <= at < e for s, e in hidden) else None
        if found and found[0] in levels and boundary in (None, found[0]):
            boundary = found[0]
            starts.append((at, at + len(line), *found))
        at += len(line)
    out = []
    head = source[: starts[0][0]] if starts else source
    if head.strip():
        out.append((0, 0, "", head))
    for i, (_, end, level, title) in enumerate(starts):
        stop = starts[i + 1][0] if i + 1 < len(starts) else len(source)
        out.append((i + 1, level, title, source[end:stop]))
    return out


# inline

_LINK = re.compile(r"\[\[:?([^\[\]|{}<>\n]+)(?:(\|)([^\[\]\n]*))?\]\]([a-z]*)")
_EXTERNAL = re.compile(r"\[((?:https?:|ftp:|mailto:|//)[^\s\[\]<>\"]+)(?:[ \t]+([^\]\n]*))?\]")
_FREE = re.compile(r"(?<![\w\[/])(?:https?|ftp)://[^\s\[\]<>\"{}|]+")


def visible(text: str) -> str:
    """Text with comments and opaque content blanked, at unchanged places."""
    out = list(text)
    for s, e in opaque_spans(text):
        out[s:e] = " " * (e - s)
    return "".join(out)


def links(text: str, trail: str = "a-z") -> list[dict]:
    """target, label, piped and trail of internal links; an empty label takes the target."""
    pattern = _LINK if trail == "a-z" else re.compile(_LINK.pattern.replace("[a-z]", f"[{trail}]"))
    return [{"target": m[1].strip(), "label": (m[3] if m[3] else m[1].strip()) + m[4], "piped": m[2] is not None, "trail": m[4]} for m in pattern.finditer(visible(text))]


def external_links(text: str) -> list[dict]:
    return [{"url": m[1], "label": m[2] or ""} for m in _EXTERNAL.finditer(visible(text))]


def free_urls(text: str) -> list[str]:
    """Bare URLs; marks that end a sentence do not belong to them."""
    return [m[0].rstrip(".,;:!?)'\"") for m in _FREE.finditer(visible(text))]


def categories(text: str, names: tuple[str, ...] = ("Category",)) -> list[dict]:
    """name and sort key of the category links outside templates."""
    bare = visible(text)
    inside = [(s, e) for s, e, kind in pairs(bare) if kind != "[["]
    out = []
    for m in re.finditer(rf"\[\[\s*(?:{'|'.join(names)})\s*:\s*([^\[\]|{{}}\n]+?)\s*(?:\|([^\[\]\n]*))?\]\]", bare, re.I):
        if not any(s <= m.start() < e for s, e in inside):
            out.append({"name": m[1], "sortkey": m[2]})
    return out


def emphasis(line: str) -> list[tuple[str, bool, bool]]:
    """(text, bold, italic) runs of a line: 2 quotes italic, 3 bold, 5 both; 4 are one
    quote and bold, more than 5 are quotes and both. An opener without a closer is text."""
    parts = re.split(r"('{2,})", line)
    marks = [i for i in range(1, len(parts), 2)]
    sizes = {}
    for i in marks:
        n = len(parts[i])
        keep = n if n in (2, 3, 5) else 3 if n == 4 else 5
        parts[i - 1] += "'" * (n - keep)
        sizes[i] = keep
    bold_left = sum(sizes[i] in (3, 5) for i in marks)
    italic_left = sum(sizes[i] in (2, 5) for i in marks)
    bold = italic = False
    out: list[list] = []

    def add(text: str) -> None:
        if text:
            if out and out[-1][1:] == [bold, italic]:
                out[-1][0] += text
            else:
                out.append([text, bold, italic])

    for i, part in enumerate(parts):
        if i not in sizes:
            add(part)
            continue
        n = sizes[i]
        if n in (3, 5):
            bold_left -= 1
            if bold or bold_left > 0:
                bold = not bold
            else:
                add("'''")
        if n in (2, 5):
            italic_left -= 1
            if italic or italic_left > 0:
                italic = not italic
            else:
                add("''")
    return [tuple(x) for x in out]


def table_grid(rows: list[list[tuple[int, int]]]) -> dict | None:
    """Size of a table whose rows hold (colspan, rowspan) cells: rows, columns, widest span.

    Cells are placed behind the spans that reach down from above. More than 512
    columns, or a span outside 1..100, is unknown (null).
    """
    open_: dict[int, int] = {}
    columns = widest = deepest = 0
    for row in rows:
        at = 0
        below = {c: n - 1 for c, n in open_.items() if n > 1}
        for colspan, rowspan in row:
            if not (1 <= colspan <= 100 and 1 <= rowspan <= 100):
                return None
            while at in open_:
                at += 1
            for c in range(at, at + colspan):
                if rowspan > 1:
                    below[c] = rowspan - 1
            at += colspan
            widest, deepest = max(widest, colspan), max(deepest, rowspan)
        columns = max(columns, at, *(c + 1 for c in open_), 0) if open_ else max(columns, at)
        if columns > 512:
            return None
        open_ = below
    return {"rows": len(rows), "columns": columns, "widest": widest, "deepest": deepest}


def cell_places(rows: list[list[tuple[int, int]]]) -> list[list[int]]:
    """The first column of each cell."""
    open_: dict[int, int] = {}
    out = []
    for row in rows:
        at, places, below = 0, [], {c: n - 1 for c, n in open_.items() if n > 1}
        for colspan, rowspan in row:
            while at in open_:
                at += 1
            places.append(at)
            if rowspan > 1:
                below |= {c: rowspan - 1 for c in range(at, at + colspan)}
            at += colspan
        out.append(places)
        open_ = below
    return out


# nowiki

# Characters that are escaped everywhere, and at the begin of a line.
NOWIKI_ALWAYS = {'"': "&#34;", "&": "&#38;", "'": "&#39;", "<": "&#60;", "=": "&#61;", ">": "&#62;", "[": "&#91;", "]": "&#93;", "{": "&#123;", "|": "&#124;", "}": "&#125;", ";": "&#59;"}


def nowiki(text: str) -> str:
    """Text escaped so that wikitext shows it as it is."""
    out = "".join(NOWIKI_ALWAYS.get(c, c) for c in text)
    out = re.sub(r"(^|\n)([#*:; \n\t\r])", lambda m: m[1] + f"&#{ord(m[2])};", out)
    out = re.sub(r"(^|\n)-(---)", r"\1&#45;\2", out)
    out = out.replace("!!", "&#33;!").replace("__", "&#95;_").replace("://", "&#58;//").replace("~~~", "~~&#126;")
    if out[:1] in ("!", "+", "-", "_", "~"):
        out = f"&#{ord(out[0])};{out[1:]}"
    if out[-1:] in ("_", "~", "!") and len(out) > 1:
        out = f"{out[:-1]}&#{ord(out[-1])};"
    out = re.sub(r"\b(ISBN|PMID|RFC)([ \t\n\r\f])", lambda m: f"{m[1]}&#{ord(m[2])};", out)
    return re.sub(r"(?i)\b(bitcoin|geo|magnet|mailto|news|sips?|sms|tel|urn|xmpp):", r"\1&#58;", out)
