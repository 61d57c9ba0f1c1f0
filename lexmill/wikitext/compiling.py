"""Pages as nested entries: spans, blocks, sections, references, media, lexemes."""

from __future__ import annotations

import re

from lexmill.wikitext import expand, presenting, scan

_S = "struct<kind:string,text:string,target:string,bold:boolean,italic:boolean,code:boolean>"
SPANS = f"array<{_S}>"
#: The stored shape; indices count from 0 within the entry, as the reader expects.
ENTRY = (
    f"struct<title:string,kind:string,language:string,sections:array<struct<level:int,title:string,blocks:array<struct<kind:string,depth:int,spans:{SPANS},table:array<array<{SPANS}>>>>>>,"
    f"references:array<struct<number:int,name:string,spans:{SPANS}>>,media:array<struct<file:string,kind:string,caption:string>>,"
    "lexemes:array<struct<kind:string,section:int,etymology:int,definitions:array<struct<block:int,parent:int,examples:array<int>,quotations:array<int>,notes:array<int>>>>>,"
    "other_sections:array<int>,fallbacks:array<string>>"
)
_INLINE = re.compile(r"\[\[:?(?P<target>[^\[\]|\n]+)(?:\|(?P<label>[^\[\]\n]*))?\]\](?P<trail>[a-z]*)|\[(?P<url>(?:https?:|ftp:|mailto:|//)[^\s\[\]]+)(?:[ \t]+(?P<name>[^\]\n]*))?\]|<(?P<tag>code|tt|kbd|nowiki)\b[^<>]*>(?P<code>.*?)</(?P=tag)\s*>|<br\s*/?>|(?P<other></?[A-Za-z][^<>]*>)", re.S | re.I)


def spans(text: str) -> list[dict]:
    """Runs of text, links and breaks, with their emphasis; other tags go, their text stays."""
    out: list[dict] = []

    def add(kind: str, shown: str, target: str | None, bold: bool, italic: bool, code: bool = False) -> None:
        if not shown and kind == "text":
            return
        if kind == "text" and out and out[-1]["kind"] == "text" and (out[-1]["bold"], out[-1]["italic"], out[-1]["code"]) == (bold, italic, code):
            out[-1]["text"] += shown
            return
        out.append({"kind": kind, "text": shown, "target": target, "bold": bold, "italic": italic, "code": code})

    for run, bold, italic in scan.emphasis(text):
        at = 0
        for m in _INLINE.finditer(run):
            add("text", run[at : m.start()], None, bold, italic)
            at = m.end()
            if m["target"] is not None:
                if not re.match(r"(?i)(?:category|file|image)\s*:", m["target"]):
                    add("link", (m["label"] or m["target"].strip()) + m["trail"], m["target"].strip(), bold, italic)
            elif m["url"]:
                add("external", m["name"] or m["url"], m["url"], bold, italic)
            elif m["tag"]:
                add("text", m["code"], None, bold, italic, m["tag"].lower() != "nowiki")
            elif not m["other"]:
                add("break", "\n", None, bold, italic)
        add("text", run[at:], None, bold, italic)
    return out


#: Deepest nesting of templates that is presented.
MAX_PRESENTED = 40
_PLACE = re.compile("\x00([0-9]+)\x00")


def presented_spans(text: str, title: str, depth: int = 0) -> tuple[list[dict], bool]:
    """``spans`` with the templates of known families presented in place, and whether a template was left as it is."""
    if "{{" not in text:
        return spans(text), False
    shown: list[list[presenting.Span]] = []
    pieces, at, left = [], 0, False
    for start, end, kind in sorted(scan.pairs(text), key=lambda p: (p[0], -p[1])):
        if start < at or kind == "[[":
            continue
        found = presenting.presented(text[start + 2 : end - 2], title) if kind == "{{" and depth < MAX_PRESENTED else None
        if found is None:
            left = True
        else:
            pieces += [text[at:start], f"\x00{len(shown)}\x00"]
            shown.append(found)
            at = end
    out: list[dict] = []
    for run in spans("".join([*pieces, text[at:]])):
        parts = _PLACE.split(run["text"])
        for i, part in enumerate(parts):
            if i % 2 == 0:
                if part or len(parts) == 1:
                    out.append({**run, "text": part})
                continue
            for piece in shown[int(part)]:
                style = {k: run[k] or bool(piece.get(k)) for k in ("bold", "italic", "code")}
                if piece["target"]:
                    outer = str(piece["target"]).startswith(("http://", "https://"))
                    out.append({"kind": "external" if outer else "link", "text": piece["text"], "target": piece["target"], **style})
                else:
                    inner, more = presented_spans(str(piece["text"]), title, depth + 1)
                    left = left or more
                    out += [{**x, **{k: x[k] or style[k] for k in style}} for x in inner]
    return out, left


def plain(parts: list[dict]) -> str:
    return "".join(p["text"] for p in parts)


def _table(lines: list[str], spans) -> list[list[list[dict]]]:
    rows: list[list[list[dict]]] = [[]]
    for line in lines:
        if line.startswith(("{|", "|}", "|+")):
            continue
        if line.startswith("|-"):
            rows.append([])
        elif line[:1] in "|!":
            cells = re.split(r"\|\||!!", line[1:]) if line[0] == "!" else line[1:].split("||")
            for cell in cells:
                attrs, bar, rest = cell.partition("|")
                rows[-1].append(spans((rest if bar and "=" in attrs and "[[" not in attrs else cell).strip()))
    return [r for r in rows if r]


def compile_page(source: str, title: str, kind: str, language: str) -> dict:
    """The entry of a page; fallbacks name what could not be shown as it stands."""
    text = expand.strip_comments(expand.own(source)).replace("\x00", "")
    references, media, fallbacks = [], [], []

    def spans(part: str) -> list[dict]:
        found, left = presented_spans(part, title)
        if left and "unexpanded-template" not in fallbacks:
            fallbacks.append("unexpanded-template")
        return found

    def reference(m: re.Match) -> str:
        name = scan.attributes(m[1] or "").get("name")
        known = next((r for r in references if name and r["name"] == name), None)
        if known is None:
            known = {"number": len(references) + 1, "name": name, "spans": []}
            references.append(known)
        if m[2]:
            known["spans"] = spans(m[2].strip())
        return f"[{known['number']}]"

    text = re.sub(r"<ref\b([^<>]*?)(?:/>|>(.*?)</ref\s*>)", reference, text, flags=re.S | re.I)
    for m in re.finditer(r"\[\[\s*(?:File|Image)\s*:\s*([^\[\]|\n]+)((?:\|[^\[\]\n]*)?)\]\]", text, re.I):
        ending = m[1].rsplit(".", 1)[-1].strip().lower()
        sort = "image" if ending in ("jpg", "jpeg", "png", "gif", "webp", "svg") else "audio" if ending in ("ogg", "oga", "wav", "mp3", "flac") else None
        media.append({"file": m[1].strip(), "kind": sort, "caption": m[2].rsplit("|", 1)[-1] if m[2] else ""})
    sections = [{"level": 0, "title": "", "blocks": []}]
    table: list[str] = []
    hidden = iter([*scan.opaque_spans(text), (len(text) + 1, len(text) + 1)])
    begin, end = next(hidden)
    at = 0
    for line in text.split("\n"):
        start, at = at, at + len(line) + 1
        line = line.rstrip("\r")
        while end <= start:
            begin, end = next(hidden)
        inside = begin < start
        if table or (line.startswith("{|") and not inside):
            table.append(line)
            if line.startswith("|}"):
                sections[-1]["blocks"].append({"kind": "table", "depth": 0, "spans": [], "table": _table(table, spans)})
                table = []
            continue
        head = None if inside else scan.heading(line)
        if head:
            sections.append({"level": head[0], "title": plain(spans(head[1])), "blocks": []})
            continue
        sort, depth, body = ("paragraph", 0, line) if inside else scan.classify_line(line)
        if sort != "blank":
            sections[-1]["blocks"].append({"kind": sort, "depth": depth, "spans": spans(body), "table": None})
    if table:
        fallbacks.append("open-table")
        sections[-1]["blocks"].append({"kind": "table", "depth": 0, "spans": [], "table": _table(table, spans)})
    if not sections[0]["blocks"]:
        sections.pop(0)
    lexemes, others = layout(sections)
    return {"title": title, "kind": kind, "language": language, "sections": sections, "references": references, "media": media, "lexemes": lexemes, "other_sections": others, "fallbacks": fallbacks}


def _named(title: str, names) -> str | None:
    bare = re.sub(r"^(.*\S) [0-9]+$", r"\1", title.strip()).lower()
    return next((n for n in names if n.lower() == bare), None)


def layout(sections: list[dict]) -> tuple[list[dict], list[int]]:
    """Lexemes of the parts of speech, with senses and their evidence, and the sections left over."""
    lexemes, others, etymology, open_ = [], [], None, None
    for at, section in enumerate(sections):
        if section["level"] <= 2:
            etymology = open_ = None
        if _named(section["title"], ("Etymology",)):
            etymology = at
        pos = _named(section["title"], scan.PARTS_OF_SPEECH)
        if pos:
            open_ = {"level": section["level"]}
            lexemes.append({"kind": pos, "section": at, "etymology": etymology, "definitions": senses(section["blocks"])})
        elif not (open_ and section["level"] > open_["level"]):
            others.append(at)
    return lexemes, others


def senses(blocks: list[dict]) -> list[dict]:
    """Definitions under the nearest shallower open one, with examples, quotations and notes."""
    out: list[dict] = []
    open_: dict[int, int] = {}
    for at, block in enumerate(blocks):
        depth = block["depth"]
        if block["kind"] == "definition":
            open_ = {d: i for d, i in open_.items() if d < depth}
            parent = open_[max(open_)] if open_ else None
            open_[depth] = len(out)
            out.append({"block": at, "parent": parent, "examples": [], "quotations": [], "notes": []})
        elif depth - 1 in open_ and (where := {"example": "examples", "quotation": "quotations", "list_detail": "notes"}.get(block["kind"])):
            out[open_[depth - 1]][where].append(at)
    return out
