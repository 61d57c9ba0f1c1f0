"""Date functions as Column builders; "now" is always a parameter, never the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.lazy import let
from lexmill.functions.strings import col

MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _names(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), index)


def two(x: Column) -> Column:
    return F.lpad(x.cast("string"), 2, "0")


def civil(seconds) -> Column:
    return F.timestamp_seconds(col(seconds))


def unix(ts) -> Column:
    return F.unix_timestamp(col(ts))


def iso_week(ts):
    return F.weekofyear(col(ts))


def weekday(ts) -> Column:
    """Sunday is 0."""
    return F.dayofweek(col(ts)) - 1


def year_day(ts):
    return F.dayofyear(col(ts))


def iso_weeks_in_year(year: Column) -> Column:
    return F.weekofyear(F.make_date(year, F.lit(12), F.lit(28)))


def iso_year(ts) -> Column:
    return F.year(F.date_add(F.date_trunc("week", col(ts)).cast("date"), 3))


#: The format tokens and what they give.
TOKENS = {
    "U": lambda t: F.unix_timestamp(t).cast("string"),
    "F": lambda t: _names(MONTHS, F.month(t)),
    "M": lambda t: F.left(_names(MONTHS, F.month(t)), F.lit(3)),
    "j": lambda t: F.dayofmonth(t).cast("string"),
    "d": lambda t: two(F.dayofmonth(t)),
    "Y": lambda t: F.year(t).cast("string"),
    "y": lambda t: two(F.year(t) % 100),
    "o": lambda t: iso_year(t).cast("string"),
    "m": lambda t: two(F.month(t)),
    "n": lambda t: F.month(t).cast("string"),
    "t": lambda t: F.dayofmonth(F.last_day(t)).cast("string"),
    "H": lambda t: two(F.hour(t)),
    "G": lambda t: F.hour(t).cast("string"),
    "h": lambda t: two((F.hour(t) + 11) % 12 + 1),
    "g": lambda t: ((F.hour(t) + 11) % 12 + 1).cast("string"),
    "a": lambda t: F.when(F.hour(t) < 12, "am").otherwise("pm"),
    "A": lambda t: F.when(F.hour(t) < 12, "AM").otherwise("PM"),
    "i": lambda t: two(F.minute(t)),
    "s": lambda t: two(F.second(t)),
    "l": lambda t: _names(DAYS, F.weekday(t) + 1),
    "D": lambda t: F.left(_names(DAYS, F.weekday(t) + 1), F.lit(3)),
    "N": lambda t: (F.weekday(t) + 1).cast("string"),
    "w": lambda t: weekday(t).cast("string"),
    "W": lambda t: two(F.weekofyear(t)),
    "z": lambda t: (F.dayofyear(t) - 1).cast("string"),
    "L": lambda t: F.when(F.dayofyear(F.make_date(F.year(t), F.lit(12), F.lit(31))) == 366, "1").otherwise("0"),
    "xg": lambda t: _names(MONTHS, F.month(t)),
}


def format_date(ts, pattern: str, tokens: dict | None = None) -> Column:
    """Text by the tokens of TOKENS or others; ``\\`` escapes, quoted text and other characters stay."""
    ts, out, i, known = col(ts), [], 0, TOKENS if tokens is None else tokens
    while i < len(pattern):
        if pattern[i] == "\\" and i + 1 < len(pattern):
            out.append(F.lit(pattern[i + 1]))
            i += 2
        elif pattern[i] == '"' and (end := pattern.find('"', i + 1)) > 0:
            out.append(F.lit(pattern[i + 1 : end]))
            i = end + 1
        elif pattern[i : i + 2] in known:
            out.append(known[pattern[i : i + 2]](ts))
            i += 2
        else:
            out.append(known[pattern[i]](ts) if pattern[i] in known else F.lit(pattern[i]))
            i += 1
    return F.concat(*out) if out else F.when(ts.isNotNull(), F.lit(""))


#: strftime directives as format tokens.
STRFTIME = {"Y": "Y", "y": "y", "m": "m", "d": "d", "H": "H", "I": "h", "M": "i", "S": "s", "B": "F", "b": "M", "A": "l", "a": "D", "p": "A", "w": "w"}


def os_date(ts, pattern: str) -> Column:
    """A strftime subset in UTC; ``%j`` and ``%%`` too, unknown directives stay."""
    ts, out, i = col(ts), [], 0
    while i < len(pattern):
        if pattern[i] == "%" and i + 1 < len(pattern):
            d = pattern[i + 1]
            out.append(TOKENS[STRFTIME[d]](ts) if d in STRFTIME else F.lpad(F.dayofyear(ts).cast("string"), 3, "0") if d == "j" else F.lit("%" if d == "%" else "%" + d))
            i += 2
        else:
            out.append(F.lit(pattern[i]))
            i += 1
    return F.concat(*out)


def os_time(year, month, day, hour=None) -> Column:
    """Unix seconds of civil fields; the hour defaults to noon."""
    return F.unix_timestamp(F.make_timestamp(col(year), col(month), col(day), F.lit(12) if hour is None else col(hour), F.lit(0), F.lit(0)))


def compact(ts) -> Column:
    """yyyymmddHHMMSS."""
    return format_date(ts, "YmdHis")


def _month_number(name: Column) -> Column:
    """The number of a month written in full or with three letters."""
    known = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS, 1) for n in {m.lower(), m[:3].lower()} for x in (n, i)])
    return known[F.lower(name)]


def _day(year: Column, month: Column, day: Column) -> Column:
    return F.call_function("try_make_timestamp", year.cast("int"), month.cast("int"), day.cast("int"), F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)"))


def _int(x: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(x, pattern, group).try_cast("int")


def parse_date(text, now: Column) -> Column:
    """A timestamp of text: ISO, hyphens, slashes, dots, month names, ``now``, ``today``,
    ``first/last day of this/last/next month`` and ``+n days``; null if unreadable."""
    return let(F.trim(col(text)), lambda x: _parsed(x, now))


def _parsed(x: Column, now: Column) -> Column:
    low = F.lower(x)
    iso = F.when(x.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}"), x.try_cast("timestamp"))
    compact14 = F.when(x.rlike("^[0-9]{14}$"), F.try_to_timestamp(x, F.lit("yyyyMMddHHmmss")))
    ymd = F.when(x.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), _day(*[_int(x, r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})$", i) for i in (1, 2, 3)]))
    ym = F.when(x.rlike(r"^[0-9]{4}-[0-9]{1,2}$"), _day(_int(x, r"^([0-9]{4})-([0-9]+)$", 1), _int(x, r"^([0-9]{4})-([0-9]+)$", 2), F.lit(1)))
    named_hyphen = r"^([0-9]{1,2})-([A-Za-z]+)-([0-9]{4})$"
    dmy_named = F.when(x.rlike(named_hyphen), _day(_int(x, named_hyphen, 3), _month_number(F.regexp_extract(x, named_hyphen, 2)), _int(x, named_hyphen, 1)))
    dmy = r"^([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})$"
    hyphen = F.when(x.rlike(dmy), _day(_int(x, dmy, 3), _int(x, dmy, 2), _int(x, dmy, 1)))
    slash4, slash = r"^([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})$", r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{2}|[0-9]{4})$"
    year = _int(x, slash, 3)
    year = F.when(year <= 69, year + 2000).when(year < 100, year + 1900).otherwise(year)
    slashed = F.when(x.rlike(slash4), _day(*[_int(x, slash4, i) for i in (1, 2, 3)])).when(x.rlike(slash), _day(year, _int(x, slash, 1), _int(x, slash, 2)))
    dot = r"^([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})$"
    dotted = F.when(x.rlike(dot), _day(_int(x, dot, 3), _int(x, dot, 2), _int(x, dot, 1)))
    dm_y, md_y, m_y = r"^([0-9]{1,2}) ([A-Za-z]+),? ([0-9]{4})$", r"^([A-Za-z]+) ([0-9]{1,2}),? ([0-9]{4})$", r"^([A-Za-z]+) ([0-9]{4})$"
    spaced = (
        F.when(x.rlike(dm_y), _day(_int(x, dm_y, 3), _month_number(F.regexp_extract(x, dm_y, 2)), _int(x, dm_y, 1)))
        .when(x.rlike(md_y), _day(_int(x, md_y, 3), _month_number(F.regexp_extract(x, md_y, 1)), _int(x, md_y, 2)))
        .when(x.rlike(m_y), _day(_int(x, m_y, 2), _month_number(F.regexp_extract(x, m_y, 1)), F.lit(1)))
    )
    edge = r"^(first|last) day of (this|last|next) month$"
    shift = F.when(F.regexp_extract(low, edge, 2) == "next", 1).when(F.regexp_extract(low, edge, 2) == "last", -1).otherwise(0)
    base = F.add_months(now, shift)
    month = F.when(low.rlike(edge), F.when(F.regexp_extract(low, edge, 1) == "first", F.trunc(base, "MM")).otherwise(F.last_day(base)).cast("timestamp"))
    step = r"^([+-]?[0-9]+) (day|week|month|year)s?$"
    n, unit = F.regexp_extract(low, step, 1).try_cast("int"), F.regexp_extract(low, step, 2)
    clock = F.unix_timestamp(now) - F.unix_timestamp(F.date_trunc("day", now))
    moved = F.when(unit == "day", F.date_add(now, n)).when(unit == "week", F.date_add(now, n * 7)).when(unit == "month", F.add_months(now, n)).when(unit == "year", F.add_months(now, n * 12))
    relative = F.when(low.rlike(step), F.timestamp_seconds(F.unix_timestamp(moved.cast("timestamp")) + clock))
    words = F.when(low.isin("now", ""), now).when(low == "today", F.date_trunc("day", now)).when(low == "yesterday", F.date_trunc("day", F.date_sub(now, 1))).when(low == "tomorrow", F.date_trunc("day", F.date_add(now, 1)))
    return F.coalesce(words, iso, compact14, ymd, ym, dmy_named, hyphen, slashed, dotted, spaced, month, relative)


def format_preference(text, preference: str, now: Column) -> Column:
    """A date as dmy, mdy, ymd or ISO 8601 in a span with its ISO form; unreadable text is only trimmed."""
    pattern = {"dmy": "j F Y", "mdy": "F j, Y", "ymd": "Y F j"}.get(preference, "Y-m-d")

    def span(ts: Column) -> Column:
        return F.concat(F.lit('<span class="mw-formatted-date" title="'), format_date(ts, "Y-m-d"), F.lit('">'), format_date(ts, pattern), F.lit("</span>"))

    return F.coalesce(let(parse_date(text, now), span), F.trim(col(text)))


def localized(ts, pattern: str, month_names: list[str], digits: str = "0123456789") -> Column:
    """format_date with another language's months and digits; literal text of the pattern stays."""
    own = {"F": lambda t: _names(month_names, F.month(t)), "xg": lambda t: _names(month_names, F.month(t)), "M": lambda t: F.left(_names(month_names, F.month(t)), F.lit(3))}

    def in_digits(token):
        return lambda t: F.translate(token(t), "0123456789", digits)

    return format_date(ts, pattern, {k: own.get(k) or in_digits(token) for k, token in TOKENS.items()})


def difference(later, earlier) -> Column:
    """Seconds between two instants, with fractions; the earlier one defaults to the epoch if null."""
    return (F.unix_micros(col(later).cast("timestamp")) - F.coalesce(F.unix_micros(col(earlier).cast("timestamp")), F.lit(0))) / 1e6
