"""Plural forms by rules in the notation of the public locale data."""

from __future__ import annotations

import re
from functools import lru_cache
from xml.etree import ElementTree

from pyspark.sql import Column

from lexmill.functions.lazy import mapped

# Families of the public plural rules, each the languages that share it and
# its forms in order; the last form takes the rest. Languages without a form of their own
# stand in the first family.
FAMILIES = [
    ("bm bo dz id ig ii in ja jbo jv jw kde kea km ko lkt lo ms my nqo root sah ses sg th to vi wo yo zh", []),
    ("am bn fa gu hi kn mr zu", ["i = 0 or n = 1"]),
    ("ff fr hy kab", ["i = 0,1"]),
    ("ast ca de en et fi fy gl it ji nl sv sw ur yi", ["i = 1 and v = 0"]),
    ("si", ["n = 0,1 or i = 0 and f = 1"]),
    ("ak bh bho guw ln mg nso pa ti wa", ["n = 0..1"]),
    ("tzm", ["n = 0..1 or n = 11..99"]),
    ("pt", ["n = 0..2 and n != 2"]),
    (
        "af asa az bem bez bg brx cgg chr ckb dv ee el eo es eu fo fur gsw ha haw hu jgo jmc ka kaj kcg kk kkj kl ks ksb ku ky lb lg mas mgo ml mn nah nb nd ne nn nnh no nr ny nyn om or os pap ps rm"
        " rof rwk saq seh sn so sq ss ssy st syr ta te teo tig tk tn tr ts ug uz ve vo vun wae xh xog",
        ["n = 1"],
    ),
    ("pt_PT", ["n = 1 and v = 0"]),
    ("da", ["n = 1 or t != 0 and i = 0,1"]),
    ("is", ["t = 0 and i % 10 = 1 and i % 100 != 11 or t != 0"]),
    ("mk", ["v = 0 and i % 10 = 1 or f % 10 = 1"]),
    ("fil tl", ["v = 0 and i = 1,2,3 or v = 0 and i % 10 != 4,6,9 or v != 0 and f % 10 != 4,6,9"]),
    ("lv prg", ["n % 10 = 0 or n % 100 = 11..19 or v = 2 and f % 100 = 11..19", "n % 10 = 1 and n % 100 != 11 or v = 2 and f % 10 = 1 and f % 100 != 11 or v != 2 and f % 10 = 1"]),
    ("lag", ["n = 0", "i = 0,1 and n != 0"]),
    ("ksh", ["n = 0", "n = 1"]),
    ("iu kw naq se sma smi smj sms", ["n = 1", "n = 2"]),
    ("shi", ["i = 0 or n = 1", "n = 2..10"]),
    ("mo ro", ["i = 1 and v = 0", "v != 0 or n = 0 or n != 1 and n % 100 = 1..19"]),
    (
        "bs hr isv-cyrl isv-latn sh sr sr-ec sr-el",
        ["v = 0 and i % 10 = 1 and i % 100 != 11 or f % 10 = 1 and f % 100 != 11", "v = 0 and i % 10 = 2..4 and i % 100 != 12..14 or f % 10 = 2..4 and f % 100 != 12..14"],
    ),
    ("gd", ["n = 1,11", "n = 2,12", "n = 3..10,13..19"]),
    ("sl", ["v = 0 and i % 100 = 1", "v = 0 and i % 100 = 2", "v = 0 and i % 100 = 3..4 or v != 0"]),
    ("dsb hsb", ["v = 0 and i % 100 = 1 or f % 100 = 1", "v = 0 and i % 100 = 2 or f % 100 = 2", "v = 0 and i % 100 = 3..4 or f % 100 = 3..4"]),
    ("he iw", ["i = 1 and v = 0", "i = 2 and v = 0", "v = 0 and n != 0..10 and n % 10 = 0"]),
    ("cs sk", ["i = 1 and v = 0", "i = 2..4 and v = 0", "v != 0"]),
    ("pl", ["i = 1 and v = 0", "v = 0 and i % 10 = 2..4 and i % 100 != 12..14", "v = 0 and i != 1 and i % 10 = 0..1 or v = 0 and i % 10 = 5..9 or v = 0 and i % 100 = 12..14"]),
    ("be be-tarask", ["n % 10 = 1 and n % 100 != 11", "n % 10 = 2..4 and n % 100 != 12..14", "n % 10 = 0 or n % 10 = 5..9 or n % 100 = 11..14"]),
    ("lt", ["n % 10 = 1 and n % 100 != 11..19", "n % 10 = 2..9 and n % 100 != 11..19", "f != 0"]),
    ("mt", ["n = 1", "n = 2", "n = 0 or n % 100 = 3..10", "n % 100 = 11..19"]),
    ("ru uk", ["v = 0 and i % 10 = 1 and i % 100 != 11", "v = 0 and i % 10 = 2..4 and i % 100 != 12..14", "v = 0 and i % 10 = 0 or v = 0 and i % 10 = 5..9 or v = 0 and i % 100 = 11..14"]),
    (
        "br",
        ["n % 10 = 1 and n % 100 != 11,71,91", "n % 10 = 2 and n % 100 != 12,72,92", "n % 10 = 3..4,9 and n % 100 != 10..19,70..79,90..99", "n != 0 and n % 1000000 = 0"],
    ),
    ("ga", ["n = 1", "n = 2", "n = 3..6", "n = 7..10"]),
    ("gv", ["v = 0 and i % 10 = 1", "v = 0 and i % 10 = 2", "v = 0 and i % 100 = 0,20,40,60,80", "v != 0"]),
    ("ar", ["n = 0", "n = 1", "n = 2", "n % 100 = 3..10", "n % 100 = 11..99"]),
    ("cy", ["n = 0", "n = 1", "n = 2", "n = 3", "n = 6"]),
    ("apc", ["n = 1", "n = 2", "n = 0 or n % 100 = 3..10"]),
    ("cu", ["n % 10 = 1", "n % 10 = 2", "n % 10 = 3..4"]),
    ("hoc hoc-latn", ["n = 0", "n = 1", "n = 2"]),
    ("sgs", ["n % 10 = 1 and n % 100 != 11", "n % 10 = 2 and n % 100 != 12", "n = 0 or n % 100 = 0 or n % 100 = 10..19"]),
    ("sjd", ["n = 1", "i = 0 or i = 2..6 or i = 1 and t != 0"]),
    ("smn", ["n = 1", "n = 2 and v = 0", "i = 0 or i = 3..6 or i = 2 and v != 0 or i = 1 and t != 0"]),
]

RULES = {code: rules for codes, rules in FAMILIES for code in codes.split()}


def load(path: str) -> dict[str, list[str]]:
    """The rules of a file in the public XML format of plural rules, by language."""
    found = {}
    for group in ElementTree.parse(path).getroot().iter("pluralRules"):
        texts = [(x.get("count"), (x.text or "").split("@")[0].strip()) for x in group.iter("pluralRule")]
        for code in group.get("locales", "").split():
            found[code] = [text for count, text in texts if count != "other"]
    return found


def rules_of(language: str, chain: tuple[str, ...] = (), rules: dict[str, list[str]] | None = None) -> list[str]:
    """The rules of the first language with any: language, its fallback chain, English.

    A language with one form only, or none known, so takes the rules of the next.
    """
    known = RULES if rules is None else rules
    return next((found for code in (language, *chain, "en") if (found := known.get(code))), [])


def operands(text: str) -> dict[str, float] | None:
    """n, i, v, w, f, t, e of a decimal number; null for other text and signed exponents."""
    if text.isdecimal() and text.isascii():
        return {"n": float(text), "i": int(text), "v": 0, "w": 0, "f": 0, "t": 0, "e": 0, "c": 0}
    m = re.fullmatch(r"\s*-?([0-9]+)(?:\.([0-9]+))?(?:[eEcC]([0-9]+))?\s*", text)
    if not m:
        return None
    whole, fraction, shift = m[1], m[2] or "", int(m[3] or 0)
    if shift:
        fraction = fraction.ljust(shift, "0")
        whole, fraction = whole + fraction[:shift], fraction[shift:]
    bare = fraction.rstrip("0")
    return {"n": float(f"{whole}.{fraction or 0}"), "i": int(whole), "v": len(fraction), "w": len(bare), "f": int(fraction or 0), "t": int(bare or 0), "e": shift, "c": shift}


@lru_cache(maxsize=512)
def rule(text: str):
    """A rule as a list of alternatives of conditions (operand, modulus, negated, ranges)."""
    out = []
    for option in text.split("@")[0].split(" or "):
        conditions = []
        for part in option.split(" and "):
            m = re.fullmatch(r"\s*([nivwftec])(?:\s*(?:%|mod)\s*([0-9]+))?\s*(!?=|is not|is|not in|in|within)\s*([0-9.,\s]+?)\s*", part)
            if not m:
                raise ValueError(f"no plural rule: {text}")
            ranges = [tuple(float(x) for x in (r.split("..") * 2)[:2]) if ".." not in r else tuple(map(float, r.split(".."))) for r in re.sub(r"\s", "", m[4]).split(",")]
            conditions.append((m[1], int(m[2] or 0), m[3] in ("!=", "is not", "not in"), ranges))
        out.append(conditions)
    return out


def _holds(conditions, values) -> bool:
    for name, modulus, negated, ranges in conditions:
        x = values[name] % modulus if modulus else values[name]
        if any(low <= x <= high and x == int(x) for low, high in ranges) == negated:
            return False
    return True


def form_index(number: str, language: str, chain: tuple[str, ...] = ()) -> int | None:
    """The 0-based form of a number by ``rules_of`` its language; null if it is no number."""
    values = operands(number)
    if values is None:
        return None
    rules = rules_of(language, chain)
    for i, text in enumerate(rules):
        if any(_holds(option, values) for option in rule(text)):
            return i
    return len(rules)


def plural(number: str, forms: list[str], language: str = "en", chain: tuple[str, ...] = ()) -> str:
    """Explicit ``n=`` forms first, then the form of the rules, the last one at most."""
    plain = forms
    if any("=" in f for f in forms):
        explicit = {k.strip(): v for k, eq, v in (f.partition("=") for f in forms) if eq and k.strip().isdigit()}
        if number.strip() in explicit:
            return explicit[number.strip()]
        plain = [f for f in forms if not (f.partition("=")[1] and f.partition("=")[0].strip().isdigit())]
    if not plain:
        return ""
    index = form_index(number.replace(",", "").replace("−", "-"), language, chain)
    return plain[min(len(plain) - 1 if index is None else index, len(plain) - 1)]


def plural_column(number: Column | str, forms: list[str], language: str = "en") -> Column:
    return mapped(lambda n: plural(n, forms, language), "string", number)


def form_index_column(number: Column | str, language: str, chain: tuple[str, ...] = ()) -> Column:
    return mapped(lambda n: form_index(n, language, chain), "int", number)


def gender(forms: list[str], language: str = "en") -> str:
    """English only: no form is empty, one form is it; more are not supported."""
    if language != "en" or len(forms) > 1:
        raise NotImplementedError("gender forms need a user's preference")
    return forms[0] if forms else ""
