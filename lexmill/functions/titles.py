"""Page titles: parts, normal form, validity, comparison."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.lazy import mapped
from lexmill.functions.strings import NO_CAPITAL, TITLE_MARKS, TITLE_SPACE, col


def lookup_key(title, kind) -> Column:
    """Kinds that own their whole title keep it; others drop everything through the first colon."""
    title, kind = col(title), col(kind)
    colon = F.instr(title, ":")
    return F.when(kind.isin("language", "supplemental") | (colon == 0), title).otherwise(F.substring(title, colon + 1, 2147483647))


def local_title(title) -> Column:
    """Without its namespace; a title that ends with its first colon stays."""
    title = col(title)
    colon = F.instr(title, ":")
    return F.when((colon > 0) & (colon < F.char_length(title)), F.substring(title, colon + 1, 2147483647)).otherwise(title)


def relevant_namespace(ns, kept: tuple[int, ...] = (0, 106, 110, 114, 116, 118)) -> Column:
    return col(ns).isin(*kept)


def space_normal(text: str) -> str:
    return re.sub(TITLE_SPACE, " ", re.sub(TITLE_MARKS, "", text)).strip()


def first_capital(text: str) -> str:
    return text if not text or text[0] in NO_CAPITAL else text[0].title()[:1] + text[1:] if len(text[0].title()) == 1 else text


def normalized(text: str, names: dict[str, tuple[int, str, str]], default: int = 0) -> tuple[int, str] | None:
    """(namespace, full title) of a title: spaces and NFC, prefix by name or alias, first
    letter as the namespace wants it. A leading colon is no default namespace; an
    unknown prefix is part of the title; no title is null.

    names: lower-case name or alias -> (id, name, case policy).
    """
    bare = unicodedata.normalize("NFC", space_normal(text))
    ns = default
    if bare.startswith(":"):
        ns, bare = 0, bare[1:].strip()
    by_id = {v[0]: v for v in names.values()}
    for _ in range(2):
        prefix, colon, rest = bare.partition(":")
        known = names.get(space_normal(prefix).lower()) if colon else None
        # an explicit prefix may repeat the default one once
        if not known or (ns not in (0, default) and known[0] != ns) or known[0] == 0:
            break
        ns, bare = known[0], rest.strip()
        if ns != default:
            break
    bare = bare.split("#")[0].strip()
    if not bare:
        return None
    _, name, policy = by_id.get(ns, (ns, "", "case-sensitive"))
    if policy == "first-letter":
        bare = first_capital(bare)
    return ns, f"{name}:{bare}" if name else bare


def registry_names(registry: DataFrame) -> dict[str, tuple[int, str, str]]:
    """The names of a registry of namespaces, one short row per namespace of the wiki."""
    out: dict[str, tuple[int, str, str]] = {}
    for r in registry.select("id", "name", "canonical_name", "case_policy").distinct().toLocalIterator():
        for name in {r["name"], r["canonical_name"]} - {None, ""}:
            if out.setdefault(name.lower(), (r["id"], r["name"] or "", r["case_policy"]))[0] != r["id"]:
                raise ValueError(f"ambiguous namespace {name}")
    return out


def normalized_column(title, names: dict[str, tuple[int, str, str]], default: int = 0) -> Column:
    """struct<ns, title> in normal form, null if nothing is left."""

    def one(text: str):
        done = normalized(text, names, default)
        return None if done is None else {"ns": done[0], "title": done[1]}

    return mapped(one, "struct<ns:int,title:string>", col(title))


# Characters no title has.
ILLEGAL = r"[\x00-\x1f\x7f#<>\[\]{}|]"


def is_valid(title, ns: Column | None = None) -> Column:
    """No illegal characters, percent codes or entities, no ``~~~``, leading colon or
    relative part, and at most 255 bytes (512 in the special namespace)."""
    title = col(title)
    most = F.lit(255) if ns is None else F.when(ns == -1, 512).otherwise(255)
    bad = (
        title.rlike(ILLEGAL)
        | title.rlike("%[0-9A-Fa-f]{2}")
        | title.rlike("&(?:[A-Za-z0-9\u0080-￿]+|#[0-9]+|#x[0-9A-Fa-f]+);")
        | title.contains("~~~")
        | title.startswith(":")
        | title.isin("", ".", "..")
        | title.rlike(r"^\.{1,2}/|/\.{1,2}/|/\.{1,2}$")
        | (F.octet_length(title) > most)
    )
    return ~bad


def title_parts(title, count: int = 0, first: int = 0) -> Column:
    """count segments from the first on (1-based); negatives count from the end, 0 is all."""
    parts = F.split(col(title), "/")
    n = F.size(parts)
    start = F.lit(first) if first > 0 else F.greatest(n + first, F.lit(0)) + 1 if first < 0 else F.lit(1)
    left = F.greatest(n - start + 1, F.lit(0))
    size = F.least(left, F.lit(count)) if count > 0 else F.greatest(left + count, F.lit(0)) if count < 0 else left
    return F.when(left > 0, F.array_join(F.slice(parts, start, size), "/")).otherwise("")


def base_page(title):
    title = col(title)
    return F.when(title.contains("/"), F.regexp_replace(title, "/[^/]*$", "")).otherwise(title)


def sub_page(title):
    return F.element_at(F.split(col(title), "/"), -1)


def root_page(title):
    return F.element_at(F.split(col(title), "/"), 1)


def is_subpage_of(a_ns, a_title, b_ns, b_title) -> Column:
    return (col(a_ns) == col(b_ns)) & F.startswith(col(a_title), F.concat(col(b_title), F.lit("/")))


def compare(a: tuple, b: tuple) -> Column:
    """-1, 0 or 1 by (interwiki, namespace, text)."""
    left, right = F.struct(*[col(x).alias(f"c{i}") for i, x in enumerate(a)]), F.struct(*[col(x).alias(f"c{i}") for i, x in enumerate(b)])
    return F.when(left < right, -1).when(left > right, 1).otherwise(0)


def full_text(prefix, title, fragment=None) -> Column:
    name = F.when(F.coalesce(col(prefix), F.lit("")) == "", col(title)).otherwise(F.concat(col(prefix), F.lit(":"), col(title)))
    return name if fragment is None else F.when(F.coalesce(col(fragment), F.lit("")) == "", name).otherwise(F.concat(name, F.lit("#"), col(fragment)))


def content_model(ns, title) -> Column:
    """The default content model of a page."""
    ns, title = col(ns), col(title)
    code = F.when(title.endswith(".css"), "css").when(title.endswith(".js"), "javascript").when(title.endswith(".json"), "json")
    return F.when((ns == 828) & title.endswith("/doc"), "wikitext").when(ns == 828, "Scribunto").when(ns.isin(2, 8), F.coalesce(code, F.lit("wikitext"))).otherwise("wikitext")


# File name endings of media.
IMAGES, SOUNDS = ("jpg", "jpeg", "png", "gif", "webp"), ("ogg", "oga", "wav", "mp3", "flac")


def media_kind(file, referenced: bool = False) -> Column:
    """image, audio or null by the ending; svg is an image where it is only referred to."""
    ending = F.lower(F.regexp_extract(col(file), r"\.([A-Za-z0-9]+)$", 1))
    return F.when(ending.isin(*IMAGES, *(["svg"] if referenced else [])), "image").when(ending.isin(*SOUNDS), "audio")


def media_type(content) -> Column:
    """The type of a file by its first bytes, null if unknown."""
    raw = F.hex(F.substring(col(content), 1, 12))
    # The first bytes of file types.
    signs = [("^FFD8FF", "image/jpeg"), ("^89504E470D0A1A0A", "image/png"), ("^47494638(37|39)61", "image/gif"), ("^52494646.{8}57454250", "image/webp"), ("^4F676753", "audio/ogg"), ("^52494646.{8}57415645", "audio/wav"), ("^494433|^FFF[23AB]", "audio/mpeg"), ("^664C6143", "audio/flac")]
    out = F.lit(None).cast("string")
    for pattern, kind in reversed(signs):
        out = F.when(raw.rlike(pattern), kind).otherwise(out)
    return out


# redirects and diagnostics


def redirect_tail(source) -> Column:
    """What follows the redirect word of a source, null if it is no redirect: the word
    stands before the first link, without brackets or tags, and the link has a target."""
    text = F.ltrim(col(source), F.lit(" \t\r\n"))
    head, target, tail = (F.regexp_extract(text, r"(?s)^([^\[]*)\[\[([^\]]*)\]\](.*)$", i) for i in (1, 2, 3))
    good = text.rlike(r"(?s)^[^\[]*\[\[[^\]]*\]\]") & (F.trim(head) != "") & ~head.rlike(r"[<>\[\]{}|]") & (F.trim(F.split(target, r"\|")[0]) != "")
    return F.when(good, F.ltrim(tail, F.lit(" \t\r\n")))


def diagnostics(text) -> Column:
    """Which kinds of trouble a rendered text shows, in a fixed order."""
    text = col(text)
    kinds = [
        ("source-markup", r"\[\[|\]\]|\{\{|\}\}|\{\||\|\}|</?[A-Za-z][^<>]*>"),
        ("behavior-switch", r"__[A-Z]{3,}__"),
        ("error-prose", r"Lua error|Expression error|class=\"[^\"]*error"),
        ("unavailable-template", r"\[\[:?Template:"),
    ]
    return F.array_compact(F.array(*[F.when(text.rlike(p), name) for name, p in kinds]))


def unresolved_syntax(text) -> Column:
    """Whether braces or strip markers are left outside of nowiki and comments."""
    bare = F.regexp_replace(col(text), r"(?is)<nowiki\b[^>]*>.*?</nowiki\s*>|<!--.*?-->", "")
    return bare.contains("{{") | bare.contains("}}") | bare.contains("\x7f")


def has_error(text) -> Column:
    return col(text).rlike(r"Lua error|Expression error|class=\"[^\"]*\berror\b")


def in_namespace(ns, *wanted: int) -> Column:
    """Whether a namespace is one of the wanted ones; a null one is none."""
    return F.coalesce(col(ns).isin(*wanted), F.lit(False))


def make_title(prefix, title, fragment=None, interwiki=None) -> Column:
    """A title put together of its parts; null where the title has no place for one or is no valid title."""
    name = full_text(prefix, title, fragment)
    whole = name if interwiki is None else F.when(F.coalesce(col(interwiki), F.lit("")) == "", name).otherwise(F.concat(col(interwiki), F.lit(":"), name))
    return F.when(is_valid(title), whole)


def transclusion_title(name, host, has_subpages) -> Column:
    """What a template name means on its host: a leading slash names a subpage of the host where
    it may have some, a leading colon a page without the template prefix."""
    name = F.trim(F.regexp_replace(col(name), "[ _]+", " "))
    sub = F.coalesce(col(has_subpages), F.lit(False)) & name.startswith("/")
    return F.when(sub, F.concat(col(host), F.regexp_replace(name, "/+$", ""))).when(name.startswith(":"), F.trim(F.substring(name, 2, 2147483647))).otherwise(name)


def is_talk(ns) -> Column:
    return F.coalesce((col(ns) > 0) & (col(ns) % 2 == 1), F.lit(False))


def is_valid_alias(a: dict[str, Column]) -> Column:
    """Whether an alias row holds together: its kinds agree with its namespaces, its keys are
    those of its titles, its fragment has at most 255 bytes, and no text is empty or holds a NUL.

    a: source_kind, source_namespace, source_title, source_key, target_kind, target_namespace, target_key, target_title, fragment.
    """
    fits = lambda kind, ns: (kind != "alias") & ((kind == "language") == (ns == 0))
    key = lambda title, kind: F.when(kind.isin("language", "supplemental") | title.contains(":"), lookup_key(title, kind))
    text = lambda x: x.isNotNull() & (x != "") & ~x.contains("\x00")
    source = fits(a["source_kind"], a["source_namespace"]) & text(a["source_title"]) & (a["source_key"] == key(a["source_title"], a["source_kind"]))
    target = F.when(a["target_kind"].isNull(), F.coalesce(a["target_key"], F.lit("")) == "").otherwise(
        a["target_namespace"].isNotNull() & fits(a["target_kind"], a["target_namespace"]) & text(a["target_key"]) & (a["target_key"] == key(a["target_title"], a["target_kind"]))
    )
    fragment = F.coalesce((F.octet_length(a["fragment"]) <= 255) & ~a["fragment"].contains("\x00"), F.lit(True))
    return F.coalesce(source & target & text(a["target_title"]) & fragment, F.lit(False))
