"""Presentation of the common dictionary templates as styled spans, without running them.

A family of templates is a recipe: a list of parts, each of which writes spans
from the parameters. A template that is in no family, or lacks what its family
needs, is not presented and stays as it is.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from urllib.parse import quote

from lexmill.wikitext import expand

# Names of languages in templates.
LANGUAGES = {
    "en": "English", "fr": "French", "de": "German", "es": "Spanish", "it": "Italian", "pt": "Portuguese", "la": "Latin", "grc": "Ancient Greek", "el": "Greek", "enm": "Middle English", "ang": "Old English",
    "gem-pro": "Proto-Germanic", "gmw-pro": "Proto-West Germanic", "ine-pro": "Proto-Indo-European", "la-lat": "Late Latin", "afa": "Afroasiatic", "ja": "Japanese", "zh": "Chinese", "ru": "Russian", "ar": "Arabic", "nl": "Dutch", "non": "Old Norse",
}


def language_label(code: str) -> str:
    """The name of a language, or its code."""
    return LANGUAGES.get(code, code)


class Call:
    """The parameters of a template; of equal keys the last counts, missing ones are empty."""

    def __init__(self, name: str, params: list[tuple[str, bool, str]], title: str = ""):
        self.name, self.title = name, title
        self.named = {k: v for k, named, v in params if named and not k.isdigit()}
        places = {int(k): v for k, _, v in params if k.isdigit()}
        self.places = dict(sorted(places.items()))

    def __getitem__(self, key: int | str) -> str:
        return (self.places if isinstance(key, int) else self.named).get(key, "")

    def first(self, *keys: int | str) -> str:
        return next((v for k in keys if (v := self[k])), "")

    def values(self, start: int) -> list[str]:
        """The positional values from start on, in order of their places, empty ones left out."""
        return [v for place, v in self.places.items() if place >= start and v]


Span = dict[str, object]
Part = Callable[[Call], Iterator[Span]]


def span(text: str, target: str | None = None, **style) -> Span:
    return {"text": text, "target": target, **{k: v for k, v in style.items() if v}}


def labelled(text: str) -> Iterator[Span]:
    """A remark in brackets."""
    if text:
        yield from (span(" (", role="label"), span(text, role="label"), span(")", role="label"))


_MODIFIER = re.compile(r"<(q|qq|t|g|tr|alt):([^<>]*)>")


def term(target: str, label: str = "", **style) -> Iterator[Span]:
    """A link to a term; modifiers behind the term are remarks, ``<alt:>`` is what is shown."""
    marks = list(_MODIFIER.finditer(target))
    if not marks or target[: marks[0].start()].find("<") >= 0:
        yield span(label or target, target, **style)
        return
    base = target[: marks[0].start()]
    shown = next((m[2] for m in reversed(marks) if m[1] == "alt"), label if label and label != target else base)
    yield span(shown, base, **style)
    for m in marks:
        if m[1] != "alt":
            yield from labelled(m[2])
    if rest := target[marks[-1].end() :]:
        yield span(rest, **style)


def text(value: str, **style) -> Part:
    return lambda call: iter([span(value, **style)])


def value(*keys: int | str, **style) -> Part:
    return lambda call: iter([span(v, **style)] if (v := call.first(*keys)) else [])


def remark(*keys: int | str) -> Part:
    return lambda call: labelled(call.first(*keys))


def joined(start: int, separator: str, links: bool = False, **style) -> Part:
    """All values from a place on with a separator between them."""

    def write(call: Call) -> Iterator[Span]:
        for i, v in enumerate(call.values(start)):
            if i:
                yield span(separator, **style)
            yield from term(v, **style) if links else [span(v, **style)]

    return write


def word(place: int, alt: int, language: int = 0, **style) -> Part:
    """A term with its qualifier, gloss and transliteration."""

    def write(call: Call) -> Iterator[Span]:
        target = call[place]
        own = {**style, "language": call[language] if language else ""}
        yield from term(target, call.first("alt", alt) or target, **own)
        yield from labelled(call["q"])
        if gloss := call.first("t", "gloss", alt + 1):
            yield from (span(" (“"), span(gloss), span("”)"))
        yield from labelled(call["tr"])

    return write


def bracketed(part: Part, left: str = "(", right: str = ")", **style) -> Part:
    def write(call: Call) -> Iterator[Span]:
        yield span(left, **style)
        yield from part(call)
        yield span(right, **style)

    return write


def lines(*keys: int | str) -> Part:
    """A value on a line of its own."""
    return lambda call: iter([span("\n"), span(v)] if (v := call.first(*keys)) else [])


def citation(call: Call) -> Iterator[Span]:
    """Author, title and so on of a quotation, in small on a line of its own."""
    started = False
    for key in ("author", "author2", "title", "work", "year", "date", "page", "pages"):
        if v := call[key]:
            yield span(", " if started else "\n", role="citation", small=True)
            if key in ("page", "pages"):
                yield span("p. ", role="citation", small=True)
            yield span(v, call["url"] or None if key == "title" else None, role="citation", small=True, italic=key == "title")
            started = True
    if started:
        yield span("\n")


# What a headword template says of the part of speech.
SPEECH = {"en-noun": "noun", "en-proper noun": "proper noun", "en-verb": "verb", "en-adj": "adjective", "en-adv": "adverb"}


def headword(call: Call) -> Iterator[Span]:
    yield span(call["head"] or call.title, role="headword", bold=True)
    yield span(" · " + (SPEECH.get(call.name) or call[2]))
    if call.name == "en-noun" and (plural := call[1]):
        if plural in "-~":
            yield from labelled("uncountable" if plural == "-" else "countable and uncountable")
        elif len(plural) > 1 and not re.search(r"[<>+?~!]", plural):
            yield from (span(" (plural "), span(plural, role="headword", bold=True), span(")"))
    yield from labelled(call["g"])


def audio(call: Call) -> Iterator[Span]:
    yield span(call.first(3, "text") or "Audio pronunciation", "https://commons.wikimedia.org/wiki/Special:FilePath/" + quote(call[2], safe=""), role="media")
    yield from labelled(call["a"])


def origin(place: int) -> Part:
    """The language a word comes from and the word there."""

    def write(call: Call) -> Iterator[Span]:
        yield span(language_label(call[place]))
        if call[place + 1] not in ("", "-"):
            yield span(" ")
            yield from word(place + 1, place + 2, place, italic=True)(call)

    return write


def encyclopedia(call: Call) -> Iterator[Span]:
    title = call[1] or call.title
    yield span(call[2] or title, "https://en.wikipedia.org/wiki/" + quote(title.replace(" ", "_"), safe=""))


# The families by the names of their templates, with what they need.
FAMILIES: list[tuple[str, tuple[int | str, ...], list[Part]]] = [
    ("non-gloss|non-gloss definition|ngd|n-g", (1,), [value(1, italic=True)]),
    ("defdate|quote-gloss", (1,), [remark(1)]),
    ("l|link|ll", (2,), [word(2, 3, 1)]),
    ("m|mention|m+", (2,), [word(2, 3, 1, italic=True)]),
    ("lb|label|lbl|tlb|term-label", (), [bracketed(joined(2, ", ", role="label"), role="label")]),
    ("q|qualifier|qual|i|a|accent", (), [bracketed(joined(1, ", ", role="label"), role="label")]),
    ("gloss|sense", (1,), [bracketed(value(1))]),
    ("ux|uxi|uxa|usex|co|coi|coa", (2,), [value(2, role="example", italic=True), lines("translation", "t", 3), remark("tr")]),
    ("quote-text|quote-book|quote-web|quote-journal|quote-song|quote-video|quote-av|quote-newsgroup|quote", ("passage|text|quote",), [value("passage", "text", "quote", role="quotation"), lines("translation", "t"), citation]),
    ("anagrams", (1, 2), [joined(2, ", ", True)]),
    ("IPA", (), [text("IPA: ", role="pronunciation"), joined(2, ", ", role="pronunciation"), remark("a", "qual")]),
    ("IPAchar", (), [joined(1, ", ", role="pronunciation"), remark("a", "qual")]),
    ("enPR", (), [text("enPR: ", role="pronunciation"), joined(1, ", ", role="pronunciation"), remark("a", "qual")]),
    ("audio", (2,), [audio]),
    ("hyph|hyphenation", (), [text("Hyphenation: "), joined(2, "·")]),
    ("rhymes", (), [text("Rhymes: "), joined(2, ", ", True)]),
    ("hmp|homophones", (), [text("Homophones: "), joined(2, ", ", True)]),
    ("alt|alter|alternative forms", (), [joined(2, ", ", True)]),
    ("syn|synonyms", (), [text("Synonyms: "), joined(2, ", ", True)]),
    ("ant|antonyms", (), [text("Antonyms: "), joined(2, ", ", True)]),
    ("hyper|hypernyms", (), [text("Hypernyms: "), joined(2, ", ", True)]),
    ("hypo|hyponyms", (), [text("Hyponyms: "), joined(2, ", ", True)]),
    ("en-noun|en-proper noun|en-verb|en-adj|en-adv|head", (), [headword]),
    ("inh|inherited|bor|borrowed|der|derived", (2,), [origin(2)]),
    ("cog|cognate|noncog", (1,), [origin(1)]),
    ("prefix|suffix|affix|compound|blend|confix", (), [joined(2, " + ", True)]),
    ("doublet|col|col1|col2|col3|col4|col5|col-u|der2|der3|der4|rel2|rel3|rel4", (), [joined(2, ", ", True)]),
    ("t|t+|t-check|t+check|tt|tt+", (2,), [lambda call: iter([span(call["alt"] or call[2], call[2], language=call[1])]), lambda call: iter([span(" ")] if call[3] else []), joined(3, ", ", small=True), remark("tr")]),
    ("trans-top|checktrans-top", (), [value(1, bold=True)]),
    ("trans-mid|trans-bottom|checktrans-mid|checktrans-bottom|top2|top3|top4|bottom|col-top|col-bottom|senseid|sid|anchor|attention|was wotd|was fwotd", (), []),
    ("ws|ws sense|ws topic", (2,), [word(2, 3, 1)]),
    ("w|wikipedia|wp|pedia|pedialite", (), [encyclopedia]),
    ("taxlink|taxfmt", (1,), [value(1, italic=True)]),
    ("small", (), [value(1, small=True)]),
    ("smallcaps|sc|nowrap", (), [value(1)]),
    ("sup", (), [value(1, superscript=True)]),
    ("sub", (), [value(1, subscript=True)]),
    ("monospace", (), [value(1, code=True)]),
    ("nb...", (), [text("…")]),
    ("reconstructed", (), [text("Reconstructed form", role="label")]),
]
# Templates that say which form of a word an entry is.
FORMS = ("plural of", "past of", "simple past of", "past participle of", "present participle of", "alternative form of", "alternative spelling of", "abbreviation of", "initialism of", "acronym of", "obsolete form of", "archaic form of", "misspelling of", "synonym of", "diminutive of")
_SAID = {"past of": "past tense of "}

_RECIPES = {name.lower(): (needs, parts) for names, needs, parts in FAMILIES for name in names.split("|")}
_RECIPES |= {form: ((2,), [text(_SAID.get(form, form + " ")), word(2, 3, 1)]) for form in FORMS}


def presented(body: str, title: str = "") -> list[Span] | None:
    """The spans of the template between the braces, null if it is in no family or lacks what that needs."""
    name, params = expand.parse_template(body)
    recipe = _RECIPES.get(name.lower())
    call = Call(name.lower(), params, title)
    if recipe is None or not all(call.first(*(n.split("|") if isinstance(n, str) else [n])) for n in recipe[0]):
        return None
    return [s for part in recipe[1] for s in part(call) if s["text"] != ""]
