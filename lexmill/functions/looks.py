"""The form of a text in which what looks the same is the same.

``look_column`` keeps all that can be seen: case, accents, raised and circled
characters. Look-alike letters are those of ``LOOKALIKES`` and, on a session with
a JVM, the single-letter pairs of the public table of confusable characters that
Spark's own Unicode library holds (``confusables``).
"""

from __future__ import annotations

import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Letters of other scripts and the Latin letters they look like; these go before those of the table.
LOOKALIKES = dict(
    zip(
        "аеорсухіјѕһԁԛԝ"
        "АВЕКМНОРСТХІЈЅԌҮ"
        "οϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcyxijshdqwABEKMHOPCTXIJSGYocjABEZHIKMNOPTYX",
        strict=True,
    )
)
# Default-ignorable code points that are not of category Cf.
IGNORABLE = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180F, 0x3164, 0xFFA0}
# Compatibility kinds that change only the width or encoding of a mark.
SAME_LOOK = {"<wide>", "<narrow>", "<noBreak>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>"}
# Visible format characters that must stay.
VISIBLE_FORMAT = {0x0600, 0x0601, 0x0602, 0x0603, 0x0604, 0x0605, 0x06DD, 0x070F, 0x08E2, 0x110BD, 0x110CD}


def _one(char: str) -> str:
    code = ord(char)
    kind = unicodedata.category(char)
    if (kind == "Cf" and code not in VISIBLE_FORMAT) or code in IGNORABLE or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF:
        return ""
    if kind == "Zs" or char in "\t\n\x0b\x0c\r\x85\u2028\u2029":
        return " "
    tag = unicodedata.decomposition(char).partition(" ")[0]
    if tag in SAME_LOOK:
        wide = unicodedata.normalize("NFKD", char)
        return wide if wide.strip() else char  # spacing accents decompose to a space and a mark
    return char


def _script(char: str) -> str:
    return unicodedata.name(char, "").split(" ")[0]


def _confusables(checker) -> dict[str, str]:
    letters = [c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) in ("Lu", "Ll") and not unicodedata.decomposition(c) and _script(c) != "LATIN"]
    latin = [c for c in map(chr, range(128)) if c.isalpha()]
    shown = checker.getSkeleton("\n".join(letters + latin)).split("\n")
    by_look: dict[str, list[str]] = {}
    for letter, skeleton in zip(latin, shown[len(letters) :], strict=True):
        by_look.setdefault(skeleton, []).append(letter)
    taken = {(_script(c), latin_one) for c, latin_one in LOOKALIKES.items()}
    found: dict[tuple[str, str], list[str]] = {}
    for letter, skeleton in zip(letters, shown, strict=False):
        same = by_look.get(skeleton, [])
        if len(same) == 1 and letter not in LOOKALIKES:
            found.setdefault((_script(letter), same[0]), []).append(letter)
    return {own[0]: latin_one for (script, latin_one), own in found.items() if len(own) == 1 and (script, latin_one) not in taken}


def confusables(spark: SparkSession | None = None) -> dict[str, str]:
    """LOOKALIKES and the cased letters of other scripts that the table of confusable
    characters gives one Latin letter. Two letters of one script never get the same
    Latin letter, so words of that script stay different. Without a JVM: LOOKALIKES."""
    spark = spark or SparkSession.getActiveSession()
    try:
        checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    except (AttributeError, TypeError):
        return LOOKALIKES
    if not _KNOWN:
        _KNOWN.update(LOOKALIKES | _confusables(checker))
    return dict(_KNOWN)


_KNOWN: dict[str, str] = {}


class _Table(dict):
    """A translation table that is filled as characters occur."""

    def __init__(self, letters: dict[str, str]):
        super().__init__()
        self.letters = letters

    def __missing__(self, code: int) -> str:
        parts = "".join(_one(c) for c in unicodedata.normalize("NFD", chr(code)))
        out = "".join(self.letters.get(c, c) for c in unicodedata.normalize("NFD", parts))
        self[code] = out = "-" if out == "\u2010" else out
        return out


_TABLE = _Table(LOOKALIKES)


def look(text: str, table: _Table = _TABLE) -> str:
    """The visible form: no ignorable characters, one kind of space, full-width
    and ligature forms opened, look-alike letters as Latin ones, accents
    composed. Case, accents, raised, circled and fraction characters stay."""
    if text.isascii():
        return text if text.isprintable() else text.translate(table)
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", text.translate(table)))


def per_distinct(form, column: Column | str) -> Column:
    """form(text, table) of a string column, once per distinct value of a batch; null stays null.

    The table of letters is small (some hundred) and goes to the workers with the function.
    """
    letters = confusables()

    def run(series: pd.Series) -> pd.Series:
        table = _Table(letters)
        codes, values = pd.factorize(series, use_na_sentinel=True)
        done = pd.Series([form(v, table) for v in values] + [None], dtype=object)
        return pd.Series(done.to_numpy()[codes], index=series.index)

    run.__annotations__ = {"series": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(F.col(column) if isinstance(column, str) else column)


def look_column(column: Column | str) -> Column:
    """``look`` of a string column; null stays null, empty stays empty."""
    return per_distinct(look, column)
