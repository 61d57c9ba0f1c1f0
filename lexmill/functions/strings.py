"""String functions as Column builders.

Two families are kept apart: byte functions (``byte_*``, ASCII case, 1-based
byte positions, results as binary where a cut may fall inside a character) and
code point functions (``u*``). Null in gives null out unless stated.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.lazy import mapped

LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _bounds(size: Column, i: int, j: int) -> tuple[Column, Column]:
    """First position and length of the 1-based range i..j; negatives count from the end."""
    first = F.greatest(size + (i + 1), F.lit(1)) if i < 0 else F.lit(max(i, 1))
    last = size + (j + 1) if j < 0 else F.least(size, F.lit(j))
    return first, F.greatest(last - first + 1, F.lit(0))


# bytes


def byte_len(x):
    return F.octet_length(col(x))


def byte_sub(x, i: int, j: int = -1) -> Column:
    """Bytes i..j as binary."""
    raw = col(x).cast("binary")
    first, n = _bounds(F.octet_length(raw), i, j)
    return F.substring(raw, first, n)


def byte_lower(x):
    return F.translate(col(x), UPPER, LOWER)


def byte_upper(x):
    return F.translate(col(x), LOWER, UPPER)


def byte_reverse(x) -> Column:
    """The bytes in reverse, as binary."""
    return F.unhex(F.array_join(F.reverse(F.regexp_extract_all(F.hex(col(x).cast("binary")), F.lit("(..)"), 1)), ""))


def rep(x, n: int, sep: str = "") -> Column:
    x = col(x)
    if n < 1:
        return F.when(x.isNotNull(), F.lit(""))
    return F.repeat(x, n) if not sep else F.concat(x, F.repeat(F.concat(F.lit(sep), x), n - 1))


def byte_at(x, i: int = 1) -> Column:
    """The code of byte i; null beyond the end."""
    at = F.hex(byte_sub(x, i, i))
    return F.when(at != "", F.conv(at, 16, 10).cast("int"))


def byte_char(*codes: int) -> Column:
    return F.lit(bytes(codes)).cast("binary")


def find_plain(x, needle: str) -> Column:
    """(first, last) code point positions of the first occurrence, null if there is none."""
    at = F.instr(col(x), needle)
    return F.when(at > 0, F.struct(at.alias("first"), (at + len(needle) - 1).alias("last")))


# code points


def ulen(x):
    return F.char_length(col(x))


def usub(x, i: int, j: int = -1) -> Column:
    x = col(x)
    first, n = _bounds(F.char_length(x), i, j)
    return F.substring(x, first, n)


def ulower(x):
    return F.lower(col(x))


def uupper(x):
    return F.upper(col(x))


def codepoints(x) -> Column:
    """The code points as an array of int; empty text has none."""
    x = col(x)
    chars = F.filter(F.split(x, ""), lambda c: c != "")
    return F.transform(chars, lambda c: F.ascii(c))


def from_codepoints(codes: Column) -> Column:
    """Text of an array of code points."""
    raw = F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c.cast("bigint")), 8, "0")), "")
    return F.decode(F.unhex(raw), "UTF-32")


def is_utf8(x):
    return F.is_valid_utf8(col(x).cast("string"))


def byte_offset(x, n: int) -> Column:
    """The 1-based byte at which code point n begins; null outside the text."""
    x = col(x)
    return F.when(F.char_length(x) >= n, F.octet_length(F.substring(x, 1, n - 1)) + 1)


# text library


def split_plain(x, sep: str) -> Column:
    """Parts between separators; an empty separator gives characters."""
    if not sep:
        return F.filter(F.split(col(x), ""), lambda c: c != "")
    return F.split(col(x), F.lit("\\Q" + sep + "\\E"), -1)


def trim(x, chars: str = "\t\r\n\f ") -> Column:
    return F.btrim(col(x), F.lit(chars))


def truncate(x, length: int, ellipsis: str = "…", adjust: bool = False) -> Column:
    """At most |length| characters kept from the left (or, if negative, the right)
    and an ellipsis, used only where that is shorter than the text."""
    x = col(x)
    keep = max(abs(length) - (len(ellipsis) if adjust else 0), 0)
    cut = F.concat(F.left(x, F.lit(keep)), F.lit(ellipsis)) if length >= 0 else F.concat(F.lit(ellipsis), F.right(x, F.lit(keep)))
    return F.when((F.char_length(x) > abs(length)) & (F.char_length(cut) < F.char_length(x)), cut).otherwise(x)


def list_to_text(items: Column, sep: str = ", ", last: str = " and ") -> Column:
    """a, b and c."""
    head = F.array_join(F.slice(items, F.lit(1), F.greatest(F.size(items) - 1, F.lit(0))), sep)
    tail = F.element_at(items, -1)
    return F.when(F.size(items) == 0, F.lit("")).when(F.size(items) == 1, tail).otherwise(F.concat(head, F.lit(last), tail))


def html_encode(x) -> Column:
    out = F.replace(col(x), F.lit("&"), F.lit("&amp;"))
    for char, name in ((">", "&gt;"), ("<", "&lt;"), ('"', "&quot;"), ("'", "&#39;"), ("\u00a0", "&nbsp;")):
        out = F.replace(out, F.lit(char), F.lit(name))
    return out


def html_decode_basic(x) -> Column:
    """The five basic entities and the non-breaking space; each is read once."""
    out = col(x)
    for name, char in (("&nbsp;", "\u00a0"), ("&#39;", "'"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(char))
    return out


# Fixed value: how strip markers are written.
MARKER = "\x7f'\"`UNIQ-[^\x7f]*-QINU`\"'\x7f"


def kill_markers(x):
    return F.regexp_replace(col(x), MARKER, "")


def has_marker(x):
    return F.coalesce(col(x).contains("\x7f"), F.lit(False))


def tag(name: str, attributes: list[tuple[str, Column | str | bool]], content: Column | None = None, close: bool = True) -> Column:
    """A tag; True gives a bare attribute, False none; without content only the opening tag, or ``<x />``."""
    parts = [F.lit(f"<{name}")]
    for key, value in attributes:
        if value is True:
            parts.append(F.lit(f" {key}"))
        elif value is not False:
            parts += [F.lit(f' {key}="'), html_encode(value if isinstance(value, Column) else F.lit(value)), F.lit('"')]
    if content is None:
        return F.concat(*parts, F.lit(">" if close else " />"))
    return F.concat(*parts, F.lit(">"), content, F.lit(f"</{name}>"))


# spacing and keys

# White space of titles and the direction marks they drop.
TITLE_SPACE = "[ _\u00a0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
TITLE_MARKS = "[\u200e\u200f\u202a-\u202e]"


def normalize_space(x) -> Column:
    """Runs of underscores and Unicode spaces as one space, no direction marks, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(col(x), TITLE_MARKS, ""), TITLE_SPACE, " "))


def category_key(x) -> Column:
    """The database key of a category: no fragment, single underscores, none outside."""
    bare = F.substring_index(col(x), "#", 1)
    return F.btrim(F.regexp_replace(bare, "[ _]+", "_"), F.lit("_"))


# First letters that have no single capital.
NO_CAPITAL = "ßŉǰΐΰև"


def first_upper(x) -> Column:
    x = col(x)
    first = F.left(x, F.lit(1))
    return F.when(first.isin(*NO_CAPITAL), x).otherwise(F.concat(F.upper(first), F.substring(x, 2, 2147483647)))


def first_lower(x) -> Column:
    x = col(x)
    return F.concat(F.lower(F.left(x, F.lit(1))), F.substring(x, 2, 2147483647))


def first_upper_in(x, language: str) -> Column:
    """First letter as the language writes it: Turkic i gets its dot."""
    x = col(x)
    if language in ("tr", "az", "kk", "kaa"):
        return F.when(F.left(x, F.lit(1)) == "i", F.concat(F.lit("İ"), F.substring(x, 2, 2147483647))).otherwise(first_upper(x))
    return first_upper(x)


def first_lower_in(x, language: str) -> Column:
    x = col(x)
    if language in ("tr", "az", "kk", "kaa"):
        return F.when(F.left(x, F.lit(1)) == "I", F.concat(F.lit("ı"), F.substring(x, 2, 2147483647))).otherwise(first_lower(x))
    return first_lower(x)


# numbers as text

NUMBER = r"^[-−]?[0-9]+(\.[0-9]+)?$"


def format_number(x, commas: bool = True) -> Column:
    """Thousands commas and a true minus sign; what is no number stays as it is."""
    x = col(x)
    whole, fraction = F.regexp_extract(x, r"^[-−]?([0-9]+)", 1), F.regexp_extract(x, r"(\.[0-9]+)$", 1)
    if commas:
        whole = F.regexp_replace(whole, r"(?<=[0-9])(?=(?:[0-9]{3})+$)", ",")
    sign = F.when(x.rlike("^[-−]"), F.lit("−")).otherwise(F.lit(""))
    return F.when(x.rlike(NUMBER), F.concat(sign, whole, fraction)).otherwise(x)


def parse_number(x) -> Column:
    """Text without commas and with an ASCII minus, as double; null if it is no number."""
    return F.regexp_replace(F.replace(col(x), F.lit(","), F.lit("")), "−", "-").try_cast("double")


def pad(x, length: Column | int, filler: str = "0", left: bool = True) -> Column:
    """Padded to length characters; longer text and unusable lengths leave it unchanged."""
    x, n = col(x), length if isinstance(length, Column) else F.lit(length)
    if not filler:
        return x
    n = F.least(n, F.lit(500))
    filled = F.lpad(x, n, F.lit(filler)) if left else F.rpad(x, n, F.lit(filler))
    return F.when((n > F.char_length(x)) & n.isNotNull(), filled).otherwise(x)


# messages


def fill_message(text, *values: Column) -> Column:
    """$1, $2 ... replaced once, from left to right; those without a value stay."""
    pieces = F.regexp_extract_all(F.concat(col(text), F.lit("")), F.lit(r"(\$[1-9]|[^$]+|\$)"), 1)
    known = F.create_map(*[x for i, v in enumerate(values, 1) for x in (F.lit(f"${i}"), v)]) if values else None
    return F.array_join(F.transform(pieces, lambda p: F.coalesce(known[p], p)) if values else pieces, "")


def is_blank_message(x):
    return F.coalesce(col(x), F.lit("")) == ""


def is_disabled_message(x):
    return F.coalesce(col(x), F.lit("")).isin("", "-")


# formats and languages

_FORMAT = re.compile(r"%([-+ #0]*)([0-9]*)(?:\.([0-9]*))?([diouxXeEfgGcsq%])|%")


def format_string(pattern: str, *values) -> Column:
    """printf for ``d i u o x X e E f g G c s q %``; too few values and unknown directives are errors."""
    out, taken, at = [], 0, 0
    for m in _FORMAT.finditer(pattern):
        out.append(F.lit(pattern[at : m.start()]))
        at = m.end()
        flags, width, precision, kind = m.groups()
        if kind is None:
            raise ValueError(f"invalid directive in {pattern}")
        if kind == "%":
            out.append(F.lit("%"))
            continue
        if taken >= len(values):
            raise ValueError(f"no value for directive {taken + 1}")
        x = values[taken]
        taken += 1
        out.append(_formatted(x if isinstance(x, Column) else F.lit(x), flags, width, precision, kind))
    return F.concat(*out, F.lit(pattern[at:]))


def _formatted(x: Column, flags: str, width: str, precision: str | None, kind: str) -> Column:
    if kind == "s":
        text = x.cast("string")
        text = F.left(text, F.lit(int(precision or 0))) if precision is not None else text
    elif kind == "q":
        text = F.concat(F.lit('"'), F.regexp_replace(F.replace(x.cast("string"), F.lit("\r"), F.lit("\\r")), r'(["\\\n])', r"\\$1"), F.lit('"'))
    elif kind == "c":
        text = F.chr(x.cast("bigint"))
    elif kind in "gG":
        return mapped(lambda v: f"%{flags}{width}{'' if precision is None else '.' + precision}{kind}" % v, "string", x.cast("double"))
    elif kind in "eEfF":
        dot = "" if precision is None else f".{int(precision or 0)}"
        return F.format_string(f"%{flags}{width}{dot}{kind}", x.cast("double"))
    else:
        java = {"i": "d", "u": "d"}.get(kind, kind)
        return F.format_string(f"%{flags}{width}{java}", x.cast("bigint"))
    if not width:
        return text
    filled = F.rpad(text, int(width), " ") if "-" in flags else F.lpad(text, int(width), " ")
    return F.when(F.char_length(text) < int(width), filled).otherwise(text)


# Languages written from right to left.
RIGHT_TO_LEFT = ("ar", "arc", "arz", "azb", "bcc", "bqi", "ckb", "dv", "fa", "glk", "he", "khw", "ks", "lrc", "mzn", "nqo", "pnb", "prs", "ps", "sd", "ug", "ur", "yi")


def direction(code) -> Column:
    """ltr or rtl of a language code; a script in the code decides over the language."""
    code = F.lower(col(code))
    script = F.regexp_extract(code, "-(arab|hebr|syrc|thaa|nkoo|latn|cyrl|deva)(?:-|$)", 1)
    right = F.when(script.isin("arab", "hebr", "syrc", "thaa", "nkoo"), True).when(script != "", False).otherwise(F.substring_index(code, "-", 1).isin(*RIGHT_TO_LEFT))
    return F.when(right, "rtl").when(code.isNotNull(), "ltr")


def arrow(which, code) -> Column:
    """The arrow forwards or backwards as the language is read, up or down; null for another word."""
    which = F.lower(col(which))
    ahead = direction(code) == "ltr"
    return F.when(which == "forwards", F.when(ahead, "→").otherwise("←")).when(which == "backwards", F.when(ahead, "←").otherwise("→")).when(which == "up", "↑").when(which == "down", "↓")


def is_language_tag(x) -> Column:
    """Whether text has the form of a language tag: a language of 2 to 8 letters and subtags of at most 8."""
    return F.coalesce(col(x).rlike("^[a-z]{2,8}(-[a-z0-9]{1,8})*$"), F.lit(False))


def simple_fold(x) -> Column:
    """Letters folded one to one: upper, then lower case where neither changes the number of letters."""
    return F.array_join(F.transform(F.filter(F.split(col(x), ""), lambda c: c != ""), _fold_one), "")


def _fold_one(c: Column) -> Column:
    up = F.upper(c)
    low = F.lower(F.when(F.char_length(up) == 1, up).otherwise(c))
    return F.when(F.char_length(low) == 1, low).otherwise(c)


def folded_prefix(x) -> Column:
    """The first two bytes of the lower-cased text: no text beyond an ASCII letter's equal fold differs in them."""
    return F.substring(F.encode(F.lower(col(x)), "UTF-8"), 1, 2)
