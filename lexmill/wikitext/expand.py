"""Template expansion: inclusion control, parameters, parser functions and magic words."""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from lexmill.functions import expression, plurals
from lexmill.wikitext import clock, modules, scan

#: Deepest nesting of expansions and of templates, most parameters of a call.
MAX_DEPTH, MAX_TEMPLATES, MAX_PARAMS = 512, 128, 16_384
#: Characters of a result and steps that every page has, and those it has more for each character.
MAX_CHARS, CHARS_EACH, STEPS_EACH = 2_000_000, 64, 8
#: Python frames that one level of nesting takes at most.
FRAMES = 8


class TemplateError(ValueError):
    pass


def strip_comments(text: str) -> str:
    """Comments go; a comment alone on its line takes the line with it."""
    text = re.sub(r"(?m)^[ \t]*<!--(?:(?!-->)[\s\S])*-->[ \t]*\n", "", text)
    return re.sub(r"<!--[\s\S]*?(?:-->|\Z)", "", text)


def transcluded(text: str) -> str:
    """What a page gives where it is included."""
    only = re.findall(r"<onlyinclude\s*>([\s\S]*?)</onlyinclude\s*>", text, re.I)
    if only:
        text = "".join(only)
    text = re.sub(r"<noinclude\s*>[\s\S]*?(?:</noinclude\s*>|\Z)|<noinclude\s*/>", "", text, flags=re.I)
    return re.sub(r"</?includeonly\s*/?>", "", text, flags=re.I)


def own(text: str) -> str:
    """What a page shows itself."""
    text = re.sub(r"<includeonly\s*>[\s\S]*?(?:</includeonly\s*>|\Z)", "", text, flags=re.I)
    return re.sub(r"</?(?:noinclude|onlyinclude)\s*/?>", "", text, flags=re.I)


def parse_template(body: str) -> tuple[str, list[tuple[str, bool, str]]]:
    """(name, parameters) of the text between the braces; a parameter is (key, named, value).

    Named values are trimmed, positional ones are not and count from 1.
    """
    head, *rest = scan.split_top(body, "|")
    if len(rest) > MAX_PARAMS:
        raise TemplateError("too many parameters")
    out, place = [], 0
    for part in rest:
        at = scan.first_top(part, "=")
        if at >= 0:
            out.append((strip_comments(part[:at]).strip(), True, part[at + 1 :].strip()))
        else:
            place += 1
            out.append((str(place), False, part))
    return strip_comments(head).strip(), out


def parameter(params: list[tuple[str, bool, str]], key: str) -> str | None:
    """The value of a parameter; the last of several counts."""
    return next((v for k, _, v in reversed(params) if k == key), None)


def missing(name: str) -> str:
    return f"[[:Template:{name}]]"


def lua_error(message: str) -> str:
    return f'<strong class="error"><span class="scribunto-error">Lua error: {html.escape(message, quote=False)}</span></strong>'


# Namespaces that magic words know; a talk page is one above its subject.
NAMESPACES = {"": 0, "talk": 1, "user": 2, "user talk": 3, "template": 10, "template talk": 11, "category": 14, "category talk": 15, "module": 828, "module talk": 829}
_NAMES = {0: "", 1: "Talk", 2: "User", 3: "User talk", 10: "Template", 11: "Template talk", 14: "Category", 15: "Category talk", 828: "Module", 829: "Module talk"}


def title_parts(title: str) -> dict[str, str]:
    """The title variables of a page."""
    prefix, colon, rest = title.partition(":")
    ns = NAMESPACES.get(prefix.strip().lower().replace("_", " ")) if colon else None
    name = rest.strip() if ns is not None else title
    ns = ns or 0
    full = f"{_NAMES[ns]}:{name}" if ns else name
    subject, talk = _NAMES.get(ns - ns % 2, ""), _NAMES.get(ns - ns % 2 + 1, "Talk")
    base, _, sub = name.rpartition("/")
    root = name.split("/")[0]
    out = {
        "PAGENAME": name, "FULLPAGENAME": full, "NAMESPACE": _NAMES[ns], "NAMESPACENUMBER": str(ns), "BASEPAGENAME": base or name, "SUBPAGENAME": sub or name, "ROOTPAGENAME": root,
        "SUBJECTSPACE": subject, "TALKSPACE": talk, "SUBJECTPAGENAME": f"{subject}:{name}".lstrip(":"), "TALKPAGENAME": f"{talk}:{name}",
    }
    return out | {k + "E": v.replace(" ", "_") for k, v in out.items() if k != "NAMESPACENUMBER"}


@dataclass
class Context:
    """What an expansion knows: the page, other pages, the pinned time, modules."""

    title: str = ""
    pages: Callable[[str], str | None] = lambda _: None
    exists: Callable[[str], bool] = lambda _: False
    now: datetime = field(default_factory=lambda: datetime(2026, 1, 1, tzinfo=UTC))
    #: module -> its functions of (arguments, parameters of the page); or a library, whose functions take a frame.
    modules: dict[str, Callable] | modules.Library = field(default_factory=dict)
    language: str = "en"
    revision: dict[str, str] = field(default_factory=dict)
    #: Languages whose messages and plural rules stand in for the language's own, in order.
    fallbacks: tuple[str, ...] = ()
    #: (language, key) -> text of an interface message, null for none.
    messages: Callable[[str, str], str | None] = lambda language, key: None
    #: (code, language to write it in) -> name, null for none.
    language_names: Callable[[str, str], str | None] = lambda code, language: None
    #: prefix -> "local" (this wiki), "literal" (stays as text) or the URL its pages are read from.
    interwiki: dict[str, str] = field(default_factory=dict)
    #: local name of a function or variable, in lower case -> the name used here.
    aliases: dict[str, str] = field(default_factory=dict)
    #: SITENAME, SERVER, SERVERNAME, SCRIPTPATH, NUMBEROFPAGES and what else is the same on all pages.
    site: dict[str, str] = field(default_factory=dict)
    #: category -> its subcategories, for trees.
    tree: Callable[[str], list[str]] = lambda _: []
    steps: int = 200_000


def outermost(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the constructs in braces that stand in no other one."""
    tops, last = [], -1
    for start, end, kind in sorted(scan.pairs(text), key=lambda p: (p[0], -p[1])):
        # braces inside of links too: a link does not hide a template
        if kind != "[[" and start >= last:
            tops.append((start, end, kind))
            last = end
    return tops


_SIGNS = {"!": "|", "!!": "||", "=": "=", "(": "{", ")": "}"}


class Expander:
    """Expands one page; a new one for every page, so calls share no state."""

    def __init__(self, context: Context):
        self.context, self.steps, self.most = context, context.steps, None
        self.variables = title_parts(context.title)

    def expand(self, text: str, params: dict[str, str] | None = None, depth: int = 0, chain: tuple[str, ...] = ()) -> str:
        """The text with all constructs replaced; params of null leaves ``{{{x}}}`` to their defaults."""
        if self.most is None:
            self.steps, self.most = self.steps + STEPS_EACH * len(text), MAX_CHARS + CHARS_EACH * len(text)
            sys.setrecursionlimit(max(sys.getrecursionlimit(), FRAMES * MAX_DEPTH + 1000))
        self.steps -= 1
        if self.steps < 0:
            raise TemplateError("step budget exceeded")
        if depth > MAX_DEPTH:
            raise TemplateError("template depth exceeded")
        if "{{" not in text:
            return text
        out, at = [], 0
        for start, end, kind in outermost(text):
            out.append(text[at:start])
            inner = text[start + len(kind) : end - len(kind)]
            out.append(self._parameter(inner, params or {}, depth, chain) if kind == "{{{" else self._call(inner, params or {}, depth, chain))
            at = end
        out.append(text[at:])
        done = "".join(out)
        if len(done) > self.most:
            raise TemplateError("result too long")
        return done

    def _parameter(self, inner: str, params: dict[str, str], depth: int, chain) -> str:
        name, *default = scan.split_top(inner, "|")
        key = self.expand(name, params, depth + 1, chain).strip()
        if key in params:
            return params[key]
        return self.expand(default[0], params, depth + 1, chain) if default else "{{{" + inner + "}}}"

    def _call(self, inner: str, params: dict[str, str], depth: int, chain) -> str:
        head, *args = scan.split_top(strip_comments(inner) if "<!--" in inner else inner, "|")
        value = lambda x: self.expand(x, params, depth + 1, chain).strip()
        name = value(head)
        for prefix in ("subst:", "safesubst:"):
            if name.lower().startswith(prefix):
                name = name[len(prefix) :].strip()
        if not args and name in _SIGNS:
            return _SIGNS[name]
        word, colon, rest = re.match(r"([^:：]*)([:：]?)(.*)", name, re.S).groups()
        if (known := self.context.aliases.get(word.strip().lower())) is not None:
            word, name = known, known + colon + rest
        key = word.strip().lower()
        if colon and (function := FUNCTIONS.get(key)):
            return function(self, rest.strip(), args, value)
        if colon and key in ("#invoke", "invoke"):
            return self._invoke(rest.strip(), args, params, value)
        magic = self._magic(word.strip(), rest.strip() if colon else None)
        if magic is not None and not args:
            return magic
        if colon and key not in NAMESPACES and (place := self.context.interwiki.get(key)) is not None:
            if place == "literal":
                return "{{" + inner + "}}"
            if place != "local":
                return f"[[:{name}]]"  # pages of other wikis are linked, not fetched
            name = rest.strip()
        target = name[1:].strip() if name.startswith(":") else name
        target = re.sub(r"^(?:template|t)\s*:\s*", "", target, flags=re.I)
        target = re.sub(r"[ _]+", " ", target)
        if not target or re.search(r"[\[\]{}|<>\n]", target):
            return "{{" + inner + "}}"
        source = self.context.pages(target)
        if source is None:
            return missing(target)
        if target in chain:
            return f'<span class="error">Template loop detected: [[:Template:{target}]]</span>'
        if len(chain) >= MAX_TEMPLATES:
            raise TemplateError("template depth exceeded")
        own_params: dict[str, str] = {}
        for key, named, raw in parse_template("x|" + "|".join(args))[1] if args else []:
            expanded = self.expand(raw, params, depth + 1, chain)
            own_params[value(key) if named else key] = expanded.strip() if named else expanded
        return self.template(target, source, own_params, depth, chain)

    def template(self, name: str, source: str, params: dict[str, str], depth: int = 0, chain: tuple[str, ...] = ()) -> str:
        """The source of a template with its parameters."""
        return self.expand(strip_comments(transcluded(source)), params, depth + 1, (*chain, name))

    def _magic(self, word: str, of: str | None) -> str | None:
        if word in self.variables:
            return (title_parts(of) if of else self.variables)[word]
        if word in self.context.revision and of is None:
            return self.context.revision[word]
        if word in self.context.site and of is None:
            return self.context.site[word]
        now = self.context.now
        clock = {
            "CURRENTYEAR": "%Y", "CURRENTMONTH": "%m", "CURRENTMONTHNAME": "%B", "CURRENTDAY2": "%d", "CURRENTDAYNAME": "%A", "CURRENTTIME": "%H:%M", "CURRENTHOUR": "%H", "CURRENTTIMESTAMP": "%Y%m%d%H%M%S", "CURRENTWEEK": "%V",
        }
        if word in clock:
            return now.strftime(clock[word])
        return {"CURRENTDAY": str(now.day), "CURRENTMONTH1": str(now.month), "CURRENTDOW": now.strftime("%w"), "CONTENTLANGUAGE": self.context.language}.get(word)

    def _invoke(self, module: str, args: list[str], params: dict[str, str], value) -> str:
        if isinstance(self.context.modules, modules.Library):
            return self._script(module, args, params, value)
        functions = self.context.modules.get(module)
        name = value(args[0]) if args else ""
        if functions is None:
            return lua_error(f'Module "{module}" is not registered.')
        function = functions.get(name) if isinstance(functions, dict) else getattr(functions, name, None)
        if not callable(function):
            return lua_error(f'The function "{name}" does not exist.')
        frame = {k: (value(v) if named else self.expand(v, params)) for k, named, v in parse_template("x|" + "|".join(args[1:]))[1]} if len(args) > 1 else {}
        try:
            return str(function(frame, dict(params)))
        except Exception as e:  # noqa: BLE001 - a module may raise anything; it becomes markup
            return lua_error(f"{e}")


    def _script(self, module: str, args: list[str], params: dict[str, str], value) -> str:
        """A function of a library, called with a frame whose parent has the page's parameters."""
        given = {k: (value(v) if named else self.expand(v, params)) for k, named, v in parse_template("x|" + "|".join(args[1:]))[1]} if len(args) > 1 else {}
        try:
            function = self.context.modules.export(module, value(args[0]) if args else "")
            out = function(modules.Frame(self, f"Module:{module}", given, modules.Frame(self, self.context.title, params)))
        except (TemplateError, RecursionError):
            raise
        except Exception as e:  # noqa: BLE001 - a module may raise anything; it becomes markup
            return lua_error(f"{e}")
        return "" if out is None else str(out)


# ---- parser functions: (expander, first argument, further arguments, evaluate) ----------


def _arg(args: list[str], i: int, value) -> str:
    return value(args[i]) if i < len(args) else ""


_DECIMAL, _INTEGER = re.compile(r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"), re.compile("[-+]?[0-9]+")


def equal(a: str, b: str) -> bool:
    """Same text, or two decimal numbers of the same value; integers are compared exactly."""
    if a == b:
        return True
    if _INTEGER.fullmatch(a) and _INTEGER.fullmatch(b):
        return int(a) == int(b)
    return bool(_DECIMAL.fullmatch(a) and _DECIMAL.fullmatch(b)) and float(a) == float(b)


def _if(x, test, args, value):
    return _arg(args, 0 if test else 1, value)


def _ifeq(x, left, args, value):
    return _arg(args, 1 if equal(left, _arg(args, 0, value)) else 2, value)


def case(arg: str) -> tuple[str, str | None]:
    """Label and result of a case of a switch; null for a label alone."""
    at = scan.first_top(arg, "=")
    return (arg, None) if at < 0 else (arg[:at], arg[at + 1 :])


def _switch(x, key, args, value):
    default, waiting, fallback = None, False, None
    for i, arg in enumerate(args):
        label, result = arg if isinstance(arg, tuple) else case(arg)
        label = value(label)
        if result is None:
            if i == len(args) - 1:
                fallback = label
            waiting = waiting or equal(key, label)
            if label == "#default":
                default = ""
            continue
        if waiting or equal(key, label):
            return value(result)
        if label == "#default":
            default = value(result)
    return default if default is not None else fallback or ""


_ERROR = re.compile(r'class="[^"]*\berror\b')


def _iferror(x, tested, args, value):
    bad = bool(_ERROR.search(tested))
    if bad:
        return _arg(args, 0, value)
    return value(args[1]) if len(args) > 1 else tested


def _ifexist(x, title, args, value):
    plain = html.unescape(title).lstrip(":").split("#")[0].replace("_", " ").strip()
    return _arg(args, 0 if plain and x.context.exists(plain) else 1, value)


def _ifexpr(x, text, args, value):
    try:
        return _arg(args, 0 if text and expression.evaluate(text) else 1, value)
    except expression.ExpressionError as e:
        return expression.error_text(str(e))


def _sub(x, text, args, value):
    start, length = ((int(v) if re.fullmatch(r"-?[0-9]+", v := _arg(args, i, value)) else 0) for i in (0, 1))
    n = len(text)
    start = max(n + start, 0) if start < 0 else min(start, n)
    end = n if not length else n + length if length < 0 else start + length
    return text[start : max(end, start)]


def _titleparts(x, title, args, value):
    parts = title.split("/")
    count, first = (int(v) if re.fullmatch(r"-?[0-9]+", v := _arg(args, i, value)) else 0 for i in (0, 1))
    start = first - 1 if first > 0 else max(len(parts) + first, 0) if first < 0 else 0
    parts = parts[start:]
    return "/".join(parts[:count] if count > 0 else parts[:count] if count < 0 else parts)


def padded(text: str, length: str, filler: str, left: bool) -> str:
    """Padded to a length in code points; a bad length leaves the text unchanged."""
    if not re.fullmatch(r"[0-9]+", length) or not filler:
        return text
    need = min(int(length), 500) - len(text)
    if need <= 0:
        return text
    pad = (filler * (need // len(filler) + 1))[:need]
    return pad + text if left else text + pad


def _pad(left: bool):
    return lambda x, text, args, value: padded(text, _arg(args, 0, value), _arg(args, 1, value) or "0", left)


_NUMBER = re.compile(r"([-−]?)([0-9]+)(\.[0-9]+)?")


def grouped(text: str, commas: bool = True) -> str:
    """A number with thousands commas and a true minus sign; other text unchanged."""
    m = _NUMBER.fullmatch(text)
    if not m:
        return text
    return ("−" if m[1] else "") + (f"{int(m[2]):,}" if commas and not m[2].startswith("0") else m[2]) + (m[3] or "")


def _formatnum(x, text, args, value):
    mode = _arg(args, 0, value).upper()
    if mode == "R":
        return text.replace(",", "").replace("−", "-")
    return grouped(text, mode != "NOSEP")


def _plural(x, number, args, value):
    return plurals.plural(number, [value(a) for a in args], x.context.language, x.context.fallbacks)


def _time(x, pattern, args, value):
    text = _arg(args, 0, value)
    at = clock.read(text, x.context.now)
    if len(args) > 1 and _arg(args, 1, value):
        raise TemplateError("time of another language")
    return clock.formatted(at, pattern) if at is not None else '<strong class="error">Error: Invalid time.</strong>'


def _int(x, key, args, value):
    """An interface message in the page's language or its fallbacks, with $1, $2 ... filled in and expanded."""
    key = key[:1].lower() + key[1:]
    text = next((t for code in (x.context.language, *x.context.fallbacks, "en") if (t := x.context.messages(code, key)) is not None), None)
    if text is None:
        return f"⧼{key}⧽"
    values = [value(a) for a in args]
    return x.expand(re.sub(r"\$([1-9])", lambda m: values[int(m[1]) - 1] if int(m[1]) <= len(values) else m[0], text))


def _language(x, code, args, value):
    return x.context.language_names(code, _arg(args, 0, value) or code) or code


def _url(server: bool):
    def function(x, title, args, value):
        name, query = title.strip(), _arg(args, 0, value)
        if not name or re.search(r"[\[\]{}|<>\n]", name):
            return ""
        name = _urlencode(x, re.sub(r"[ _]+", " ", name), ["WIKI"], value)
        base = x.context.site.get("SERVER", "") if server else ""
        path = x.context.site.get("SCRIPTPATH", "/w") + f"/index.php?title={name}&{query}" if query else "/wiki/" + name
        return html.escape(base + path, quote=False) if query else base + path

    return function


def _categorytree(x, category, args, value):
    """Nested lists of subcategories; depth=N levels (1, at most 16), a category that comes again is not opened."""
    options = dict((k.strip(), v.strip()) for k, eq, v in ((value(a)).partition("=") for a in args) if eq)
    depth = int(options["depth"]) if re.fullmatch("[0-9]+", options.get("depth", "")) else 1
    root = re.sub(r"^category:", "", category, flags=re.I).strip()

    def level(name: str, left: int, above: tuple[str, ...]) -> str:
        kids = x.context.tree(name) if left > 0 and name not in above else []
        inner = "".join(level(k, left - 1, (*above, name)) for k in kids)
        return f"<li>[[:Category:{name}|{name}]]{f'<ul>{inner}</ul>' if inner else ''}</li>"

    return f'<ul class="CategoryTree">{level(root, min(depth, 16), ())}</ul>'


def _urlencode(x, text, args, value):
    from urllib.parse import quote, quote_plus

    mode = _arg(args, 0, value).upper()
    if mode == "PATH":
        return quote(text, safe="~")
    if mode == "WIKI":
        return quote(text.replace(" ", "_"), safe=";@$!*(),/~:")
    return quote_plus(text, safe="")


# Names of the known extension tags.
TAGS = {
    "nowiki", "pre", "gallery", "indicator", "ref", "references", "templatestyles", "math", "ce", "chem", "score", "syntaxhighlight", "source", "timeline",
    "hiero", "poem", "categorytree", "charinsert", "graph", "mapframe", "maplink", "section", "inputbox", "imagemap", "dynamicpagelist", "phonos",
}


def _tag(x, name, args, value):
    name = name.strip().lower()
    if name not in TAGS:
        return f'<strong class="error">Unknown extension tag "{html.escape(name)}"</strong>'
    content = _arg(args, 0, value)
    attributes = {}
    for a in args[1:]:
        k, eq, v = a.partition("=")
        if eq:
            attributes[value(k)] = value(v).strip("\"'")
    shown = "".join(f' {k}="{html.escape(v)}"' for k, v in sorted(attributes.items()))
    return f"<{name}{shown}>{content}</{name}>"


def _lst(x, page, args, value):
    source = x.context.pages(page)
    if source is None:
        return missing(page)
    name = re.escape(_arg(args, 0, value))
    found = re.findall(rf"""<section\s+begin\s*=\s*["']?{name}["']?\s*/>([\s\S]*?)<section\s+end\s*=\s*["']?{name}["']?\s*/>""", source)
    return x.expand("".join(found))


def _first(up: bool):
    return lambda x, text, args, value: (text[:1].upper() if up else text[:1].lower()) + text[1:]


FUNCTIONS: dict[str, Callable] = {
    "#if": _if,
    "#ifeq": _ifeq,
    "#switch": _switch,
    "#iferror": _iferror,
    "#ifexist": _ifexist,
    "#ifexpr": _ifexpr,
    "#expr": lambda x, text, args, value: expression.expr(text),
    "#len": lambda x, text, args, value: str(len(re.sub("\x7f[^\x7f]*\x7f", "", text))),
    "#sub": _sub,
    "#titleparts": _titleparts,
    "#tag": _tag,
    "#lst": _lst,
    "lc": lambda x, text, args, value: text.lower(),
    "uc": lambda x, text, args, value: text.upper(),
    "lcfirst": _first(False),
    "ucfirst": _first(True),
    "padleft": _pad(True),
    "padright": _pad(False),
    "formatnum": _formatnum,
    "plural": _plural,
    "urlencode": _urlencode,
    "gender": lambda x, text, args, value: plurals.gender([value(a) for a in args], x.context.language),
    "anchorencode": lambda x, text, args, value: re.sub(r"[ _]+", "_", html.unescape(text)).strip("_"),
    "ns": lambda x, text, args, value: _NAMES.get(int(text) if re.fullmatch(r"[0-9]+", text) else NAMESPACES.get(text.lower(), 0), ""),
    "nse": lambda x, text, args, value: _NAMES.get(int(text) if re.fullmatch(r"[0-9]+", text) else NAMESPACES.get(text.lower(), 0), "").replace(" ", "_"),
    "localurl": _url(False),
    "fullurl": _url(True),
    "canonicalurl": _url(True),
    "#time": _time,
    "#formatdate": lambda x, text, args, value: clock.preferred(text, _arg(args, 0, value), x.context.now),
    "#dateformat": lambda x, text, args, value: clock.preferred(text, _arg(args, 0, value), x.context.now),
    "int": _int,
    "#language": _language,
    "#categorytree": _categorytree,
}


# ---- references ------------------------------------------------------------------------


def references(source: str, host: str | None = None, included: bool = False) -> dict:
    """Templates and modules a source refers to: refs [(kind, target)] and whether some
    template or module name is only known at expansion (dynamic_template, dynamic_module).

    Heads that are ``#if`` or ``#ifeq`` with plain branches count with all branches.
    """
    text = strip_comments(transcluded(source) if included else source)
    refs: list[tuple[str, str]] = []
    flags = {"dynamic_template": False, "dynamic_module": False}
    found = scan.pairs(text)
    if len(found) and _nesting(found) >= scan.MAX_DEPTH:
        flags = dict.fromkeys(flags, True)
    for start, end, kind in found:
        if kind != "{{":
            continue
        head, *args = scan.split_top(text[start + 2 : end - 2], "|")
        head = re.sub(r"^\s*(?:subst|safesubst)\s*:", "", head, flags=re.I).strip()
        m = re.match(r"(#?[^:：{}\[\]]*)[:：](.*)", head, re.S)
        word = m[1].strip().lower() if m else ""
        if word == "#invoke":
            module = m[2].strip()
            if "{{" in module:
                flags["dynamic_module"] = True
            elif module:
                refs.append(("module", module.replace("_", " ")))
        elif word in FUNCTIONS or head in _SIGNS:
            continue
        elif "{{" in head:
            names = _finite(head)
            if names is None:
                flags["dynamic_template"] = True
            else:
                refs += [("template", n) for n in names]
        elif head and not re.search(r"[\[\]<>\n]", head):
            name = re.sub(r"^(?:template)\s*:\s*", "", head.lstrip(":"), flags=re.I)
            if head.startswith("/") and host:
                name = f"{host}{head}"
            if name not in title_parts(""):
                refs.append(("template", re.sub(r"[ _]+", " ", name).strip()))
    return {"refs": refs, **flags}


def _nesting(found: list[tuple[int, int, str]]) -> int:
    depth = best = 0
    for _, step in sorted([(s, 1) for s, _, _ in found] + [(e, -1) for _, e, _ in found]):
        depth += step
        best = max(best, depth)
    return best


def _finite(head: str) -> list[str] | None:
    """All names a head can have, if it is text around one #if or #ifeq with plain branches."""
    m = re.fullmatch(r"([^{}]*)\{\{\s*#(if|ifeq)\s*:([\s\S]*)\}\}([^{}]*)", head)
    if not m:
        return None
    parts = scan.split_top(m[3], "|")
    branches = [p.strip() for p in parts[1 if m[2] == "if" else 2 :]][:2]
    if any("{{" in b for b in branches):
        return None
    branches += [""] * (2 - len(branches))
    return [n for n in dict.fromkeys((m[1] + b + m[4]).strip() for b in branches) if n]
