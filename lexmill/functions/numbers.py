"""Number functions as Column builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.strings import col

MASK = 0xFFFFFFFF

#: One-argument functions by their library names.
ONE = {
    "abs": F.abs, "ceil": F.ceil, "floor": F.floor, "exp": F.exp, "sin": F.sin, "cos": F.cos, "tan": F.tan, "atan": F.atan, "deg": F.degrees, "rad": F.radians,
    "sqrt": lambda x: F.sqrt(x), "log": F.ln, "log10": F.log10,
    "asin": lambda x: F.when(x.between(-1, 1), F.asin(x)), "acos": lambda x: F.when(x.between(-1, 1), F.acos(x)),
}


def fmod(x, y) -> Column:
    """The remainder with the sign of the dividend; null for a divisor of 0."""
    return F.when(col(y) != 0, col(x) % col(y))


def expr_mod(x, y) -> Column:
    """Both sides truncated first; null for a divisor of 0."""
    whole = [F.when(v >= 0, F.floor(v)).otherwise(F.ceil(v)).cast("bigint") for v in (col(x), col(y))]
    return F.when(whole[1] != 0, whole[0] % whole[1])


def modf(x) -> Column:
    """(whole, fraction), both with the sign of x."""
    x = col(x)
    whole = F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x)).cast("double")
    return F.struct(whole.alias("whole"), (x - whole).alias("fraction"))


def round_half_up(x, digits: int = 0) -> Column:
    """Half away from zero after scaling in binary: 1.005 to two digits is 1.0."""
    x, scale = col(x), F.lit(10.0 ** abs(digits))
    scaled = x * scale if digits >= 0 else x / scale
    whole = F.signum(x) * F.floor(F.abs(scaled) + 0.5)
    return whole / scale if digits >= 0 else whole * scale


def maximum(*xs) -> Column:
    """The greatest; null if any is null."""
    xs = [col(x) for x in xs]
    known = xs[0].isNotNull()
    for x in xs[1:]:
        known = known & x.isNotNull()
    return F.when(known, F.greatest(*xs))


def minimum(*xs) -> Column:
    xs = [col(x) for x in xs]
    known = xs[0].isNotNull()
    for x in xs[1:]:
        known = known & x.isNotNull()
    return F.when(known, F.least(*xs))


def bit_and(*xs) -> Column:
    out = F.lit(MASK).cast("bigint")
    for x in xs:
        out = out.bitwiseAND(col(x).cast("bigint"))
    return out.bitwiseAND(F.lit(MASK).cast("bigint"))


def bit_or(*xs) -> Column:
    out = F.lit(0).cast("bigint")
    for x in xs:
        out = out.bitwiseOR(col(x).cast("bigint"))
    return out.bitwiseAND(F.lit(MASK).cast("bigint"))


def to_number(x, base: int = 10) -> Column:
    """A number of text in base 2 to 36; null if a character is no digit of it."""
    x = F.trim(col(x))
    if base == 10:
        return F.when(x.rlike(r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"), x.try_cast("double")).when(x.rlike("^0[xX][0-9a-fA-F]+$"), F.conv(F.substring(x, 3, 16), 16, 10).cast("double"))
    digits = "0123456789abcdefghijklmnopqrstuvwxyz"[:base]
    return F.when(F.lower(x).rlike(f"^-?[{digits}]+$"), F.when(x.startswith("-"), -1).otherwise(1) * F.conv(F.ltrim(x, F.lit("-")), base, 10).cast("double"))


def to_text(x) -> Column:
    """A double with up to 14 significant digits: no trailing zeros, whole numbers without a point."""
    x = col(x).cast("double")
    return F.when((x == F.floor(x)) & (F.abs(x) < 1e15), x.cast("bigint").cast("string")).otherwise(F.regexp_replace(F.format_string("%.14g", x), r"(\.[0-9]*?)0+$", "$1"))


def same_number(a, b) -> Column:
    """Equal text, or two decimal numbers of equal value: integers exactly, else as doubles."""
    a, b = F.trim(col(a)), F.trim(col(b))
    whole, number = r"^[-+]?[0-9]{1,37}$", r"^[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?$"
    ints = a.rlike(whole) & b.rlike(whole) & (a.try_cast("decimal(38,0)") == b.try_cast("decimal(38,0)"))
    floats = a.rlike(number) & b.rlike(number) & ~(a.rlike(whole) & b.rlike(whole)) & (a.try_cast("double") == b.try_cast("double"))
    return (a == b) | F.coalesce(ints, F.lit(False)) | F.coalesce(floats, F.lit(False))


def power(x, y) -> Column:
    return F.pow(col(x), col(y))


def random_between(seed: int, *keys, low: int = 0, high: int | None = None) -> Column:
    """A number a row's keys and the seed decide: in [0, 1) without bounds, else a whole one from low to high.

    The same row gets the same number however often it is computed.
    """
    unit = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *[col(k).cast("string") for k in keys])), 1, 13), 16, 10).cast("double") / float(1 << 52)
    return unit if high is None else (F.floor(unit * (high - low + 1)) + low).cast("bigint")


def value_type(x: Column, type_name: str) -> Column:
    """The script type of a column of a Spark type: nil, boolean, number, string or table."""
    known = {"boolean": "boolean", "string": "string"}
    kind = known.get(type_name) or ("table" if type_name.startswith(("array", "map", "struct", "variant")) else "number")
    return F.when(x.isNull(), "nil").otherwise(kind)


def same_value(a, b) -> Column:
    """Equality in which null equals null."""
    return col(a).eqNullSafe(col(b))
